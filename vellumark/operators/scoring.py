"""Agreement between two readings of the same blocks, and the cost of reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squash


def set_f1(ours: Column, theirs: Column) -> Column:
    """F1 of two sets; null where both are empty, 0 where one is."""
    a, b = F.array_distinct(ours), F.array_distinct(theirs)
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), None).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(2.0 * both / (F.size(a) + F.size(b)))


def _said(items: Column, part) -> Column:
    return F.transform(F.coalesce(items, F.array()), lambda x: squash(F.coalesce(part(x), F.lit(""))))


def compare_readings(ours: DataFrame, theirs: DataFrame, keys: tuple[str, ...] = ("doc_id", "seq")) -> DataFrame:
    """keys, the F1 of entities, topics and claims, and `score`, their mean without nulls; 1 where all are null."""
    text = lambda c: F.transform(F.coalesce(c, F.expr("array()").cast("array<string>")), lambda x: squash(x))
    sets = lambda side: {
        "entities": F.transform(F.filter(f"{side}.entities", lambda e: e["name"].isNotNull()), lambda e: squash(e["name"])),
        "topics": text(F.col(f"{side}.topics")),
        "claims": F.transform(F.col(f"{side}.claims"), lambda c: F.concat_ws("|", squash(c["subject"]), squash(c["predicate"]), c["polarity"].cast("string"))),
    }
    none = F.expr("array()").cast("array<string>")
    a, b = sets("a"), sets("b")
    joined = ours.alias("a").join(theirs.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])
    fields = {f: set_f1(F.coalesce(a[f], none), F.coalesce(b[f], none)) for f in a}
    scored = joined.select(*[F.col(f"a.{k}") for k in keys], *[v.alias(f) for f, v in fields.items()])
    known = F.filter(F.array(*fields), lambda v: v.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda s, v: s + v) / F.size(known)
    return scored.withColumn("score", F.when(F.size(known) == 0, 1.0).otherwise(mean))


def stability(first: DataFrame, second: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """One row on two runs of scores (id, score): means, gap, standard error over ids in both, and whether they agree.

    The gap is that of the runs' whole means; its tolerance is twice the standard error of the paired
    differences, or `tolerance` if that is more. t is null without spread or with fewer than two pairs.
    """
    paired = first.select("id", F.col("score").alias("a")).join(second.select("id", F.col("score").alias("b")), "id")
    d = paired.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.stddev_samp(F.col("a") - F.col("b")) / F.sqrt(F.count(F.lit(1))), F.lit(0.0)).alias("se"))
    m1, m2 = first.agg(F.avg("score").alias("mean1")), second.agg(F.avg("score").alias("mean2"))
    row = m1.join(m2).join(d).withColumn("gap", F.abs(F.col("mean1") - F.col("mean2"))).withColumn("tol", F.greatest(F.lit(tolerance), 2 * F.col("se")))
    r = lambda c: F.round(c, 6).alias(c)
    return row.select("n", r("mean1"), r("mean2"), r("gap"), r("se"), r("tol"), (F.col("gap") <= F.col("tol")).alias("same"), F.round(F.col("gap") / F.when(F.col("se") > 0, F.col("se")), 4).alias("t"))


# Price of a million tokens that miss the cache, hit it, or come out.
PRICE_MISS, PRICE_HIT, PRICE_OUT = 0.14, 0.0028, 0.28


def cost(miss: Column, hit: Column, out: Column) -> Column:
    return (miss * PRICE_MISS + hit * PRICE_HIT + out * PRICE_OUT) / 1e6


def meter(calls: DataFrame, usage: str = "usage_tokens") -> DataFrame:
    """One row: calls, tokens that hit, missed, came out and were reasoned, their cost and the rate of hits; nulls count as 0.

    Where a call doesn't say what missed but how long its prompt was, the rest of the prompt missed.
    """
    fields = {f.name for f in calls.schema[usage].dataType.fields}
    of = lambda f: F.greatest(F.coalesce(F.col(f"{usage}.{f}"), F.lit(0)), F.lit(0)) if f in fields else F.lit(0)
    missed = F.coalesce(F.col(f"{usage}.miss"), F.col(f"{usage}.prompt") - of("hit")) if "prompt" in fields else F.col(f"{usage}.miss")
    s = lambda c, f: F.coalesce(F.sum(F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))), F.lit(0)).cast("bigint").alias(f)
    t = calls.agg(F.count(F.lit(1)).alias("calls"), s(of("hit"), "hit"), s(missed, "miss"), s(of("out"), "out"), s(of("reasoning"), "reasoning"))
    whole = F.col("hit") + F.col("miss")
    return t.select("*", F.round(cost(F.col("miss"), F.col("hit"), F.col("out")), 6).alias("usd"), F.round(F.when(whole > 0, F.col("hit") / whole).otherwise(0.0), 4).alias("hit_rate"))


def gate(rows: DataFrame, cap: float, out_tokens: int = 2_600, hit_share: float = 0.46) -> DataFrame:
    """One row: what reading these rows would cost at worst and realistically, and whether that is above the cap."""
    t = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("tokens"), F.lit(0)).cast("bigint").alias("tokens"))
    out = F.col("rows") * out_tokens
    hit = F.floor(F.col("tokens") * hit_share)
    worst, real = cost(F.col("tokens"), F.lit(0), out), cost(F.col("tokens") - hit, hit, out)
    return t.select("rows", "tokens", F.round(worst, 6).alias("worst_usd"), F.round(real, 6).alias("realistic_usd"), (worst > cap).alias("refused"))


def usage_estimate(text: Column) -> Column:
    """Tokens of a text whose provider doesn't count: a quarter of its characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.coalesce(F.char_length(text), F.lit(0)) / 4)).cast("bigint")


def supporting(rows: DataFrame, term: str, most: int = 6, else_first: int = 4) -> DataFrame:
    """Rows (doc_id, seq, text, tokens) whose text holds a term in any case, the longest first, `most` at most; where none does the first rows."""
    held = rows.where(F.contains(F.lower("text"), F.lit(term.lower()))).orderBy(F.desc("tokens"), "doc_id", "seq").limit(most).withColumn("__held", F.lit(True))
    either = held.unionByName(rows.orderBy("doc_id", "seq").limit(else_first).withColumn("__held", F.lit(False)))  # some ten rows
    return either.withColumn("__any", F.max("__held").over(Window.partitionBy(F.lit(0)))).where(F.col("__held") == F.col("__any")).drop("__held", "__any")


def in_windows(ts: Column, hours: list[tuple[int, int]], offset_minutes: int = 480) -> Column:
    """Whether a UTC time, moved by an offset, lies in any of some half-open windows of minutes of the day."""
    minute = F.pmod(F.hour(ts) * 60 + F.minute(ts) + offset_minutes, F.lit(1440))
    hit = F.lit(False)
    for a, b in hours:
        hit = hit | ((minute >= a) & (minute < b))
    return hit
