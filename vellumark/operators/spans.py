"""Where quotes stand in the text they are from, and how well they are quoted."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import squash, strip_space
from ..session import on_workers, worker_udf


def locate(text: str | None, quote: str | None) -> tuple[int, int, str] | None:
    """(start, end, method) of a quote: as it is ('find'), else with any white space between its words and in any case ('whitespace')."""
    if not text or not quote or not (wanted := quote.strip()):
        return None
    if (at := text.find(wanted)) >= 0:
        return at, at + len(wanted), "find"
    if m := re.search(r"\s+".join(map(re.escape, wanted.split())), text, re.IGNORECASE):
        return m.start(), m.end(), "whitespace"
    return None


def quotes_with_text(cards: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per quote of each card, blank ones numbered too, with its block's text; null where there is no block."""
    q = cards.select("doc_id", "seq", "run_id", F.posexplode("quotes").alias("quote", "q"))
    flat = q.select("doc_id", "seq", "run_id", "quote", F.col("q.text").alias("quote_text"), F.col("q.span_start").alias("said_start"), F.col("q.span_end").alias("said_end"))
    return flat.join(blocks.select("doc_id", "seq", "text"), ["doc_id", "seq"], "left")


def found_spans(quotes: DataFrame) -> DataFrame:
    """Quotes found word for word: (doc_id, seq, run_id, quote, span_start, span_end), by built-in functions alone."""
    wanted = strip_space(F.col("quote_text"))
    at = F.position(wanted, F.col("text"))
    hit = quotes.withColumn("__w", wanted).withColumn("__at", at).where((F.col("__w") != "") & (F.col("__at") > 0))
    return hit.select("doc_id", "seq", "run_id", "quote", (F.col("__at") - 1).alias("span_start"), (F.col("__at") - 1 + F.char_length("__w")).alias("span_end"))


def located_spans(quotes: DataFrame) -> DataFrame:
    """Quotes found word for word or by their words: the columns of found_spans and `method`.

    Only quotes that built-in functions don't find are looked for in Python.
    """
    wanted = strip_space(F.col("quote_text"))
    easy = found_spans(quotes).withColumn("method", F.lit("find"))
    hard = quotes.where(F.col("text").isNotNull() & (wanted != "") & (F.position(wanted, F.col("text")) == 0)).select("doc_id", "seq", "run_id", "quote", "text", "quote_text")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, seq, run_id, quote, text, wanted in b.itertuples(index=False):
                if (hit := locate(text, wanted)) is not None:
                    out.append((doc_id, seq, run_id, quote, *hit))
            yield pd.DataFrame(out, columns=["doc_id", "seq", "run_id", "quote", "span_start", "span_end", "method"])

    return easy.unionByName(on_workers(hard).mapInPandas(search, "doc_id string, seq int, run_id string, quote int, span_start int, span_end int, method string"))


def located_quotes(text: Column, quotes: Column) -> Column:
    """Of an array of quotes those found in a text, as (quote, text, span_start, span_end, method); for a few rows, as of a report."""
    kind = T.ArrayType(T.StructType([T.StructField("quote", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("span_start", T.IntegerType()), T.StructField("span_end", T.IntegerType()), T.StructField("method", T.StringType())]))

    @worker_udf(kind)
    def find(rows: pd.DataFrame) -> pd.Series:
        def one(t: str | None, said: list | None) -> list[dict]:
            hits = [(i, locate(t, q)) for i, q in enumerate(said if said is not None else [])]
            return [{"quote": i, "text": t[h[0] : h[1]], "span_start": h[0], "span_end": h[1], "method": h[2]} for i, h in hits if h]

        return pd.Series([one(t, q) for t, q in zip(rows["text"], rows["said"], strict=True)])

    return find(F.struct(text.alias("text"), quotes.alias("said")))


def quote_class(text: Column, quote: Column, start: Column, end: Column) -> Column:
    """How a quote relates to its text: exact, substring, normalized or miss, with no_offset_ where it says no place."""
    said = F.substring(text, start + 1, end - start)
    wanted = strip_space(quote)
    inside = (wanted != "") & (F.position(wanted, text) > 0)
    loosely = (squash(quote) != "") & (F.position(squash(quote), squash(text)) > 0)
    without = F.when(inside, "no_offset_hit").when(loosely, "no_offset_norm").otherwise("no_offset_miss")
    exact = (said == quote) | ((wanted != "") & (strip_space(said) == wanted))
    return F.when((start < 0) | (end <= start), without).when(exact, "exact").when(inside, "substring").when(loosely, "normalized").otherwise("miss")


def claim_class(text: Column, span: Column) -> Column:
    """valid, invalid or absent: whether a claim's span lies inside its text."""
    s, e = span["span_start"], span["span_end"]
    return F.when(span.isNull() | s.isNull() | e.isNull(), "absent").when((s >= 0) & (s < e) & (e <= F.char_length(text)), "valid").otherwise("invalid")


def fence_report(cards: DataFrame, blocks: DataFrame, limit: int | None = None, misses: int = 10) -> DataFrame:
    """One row: quotes by class, claims by class, the rates of quotes verified, exact and not located, and the first misses.

    Cards without block are counted as unfetchable and left out of the rest; every card row counts, also of
    a block read twice. `limit` takes the first cards by key only; none, or 0, is all. Rates are null where
    there are no quotes. Each card is judged where it meets its text, so texts are read and moved once.
    """
    if limit:
        cards = cards.orderBy("doc_id", "seq", "run_id").limit(limit)
    fetched = cards.select("doc_id", "seq", "quotes", "claims").join(blocks.select("doc_id", "seq", "text"), ["doc_id", "seq"], "left")
    kinds = ("exact", "substring", "normalized", "miss", "no_offset_hit", "no_offset_norm", "no_offset_miss")
    has = F.col("text").isNotNull()
    said = F.when(has, F.transform(F.coalesce("quotes", F.expr("array()")), lambda q: quote_class(F.col("text"), F.coalesce(q["text"], F.lit("")), F.coalesce(q["span_start"], F.lit(-1)), F.coalesce(q["span_end"], F.lit(-1)))))
    held = F.when(has, F.transform(F.coalesce("claims", F.expr("array()")), lambda k: claim_class(F.col("text"), k["span"])))
    lost = F.filter(F.transform(F.arrays_zip(F.col("quotes"), F.col("said")), lambda z, i: F.struct("doc_id", "seq", i.alias("quote"), z["quotes"]["text"].alias("text"), z["said"].alias("c"))), lambda m: m["c"].isin("miss", "no_offset_miss"))
    judged = fetched.select("doc_id", "seq", "quotes", has.alias("has"), said.alias("said"), held.alias("held")).withColumn("lost", F.when(F.size("said") > 0, lost)).select("has", "said", "held", F.when(F.size("lost") > 0, F.slice("lost", 1, misses)).alias("lost"), "doc_id", "seq")
    n = lambda c, k: F.coalesce(F.sum(F.size(F.filter(c, lambda x: x == k))), F.lit(0)).cast("bigint")
    one = judged.agg(
        F.count(F.lit(1)).alias("cards"), F.count_if(~F.col("has")).alias("unfetchable"), F.coalesce(F.sum(F.size("said")), F.lit(0)).cast("bigint").alias("quotes"), *[n("said", k).alias(k) for k in kinds],
        *[n("held", k).alias(f"claims_{k}") for k in ("valid", "invalid", "absent")],
    )
    first = judged.where("lost is not null").orderBy("doc_id", "seq").limit(misses).agg(F.slice(F.array_sort(F.flatten(F.collect_list("lost"))), 1, misses).alias("misses"))
    rate = lambda *c: F.round(sum(F.col(x) for x in c) / F.when(F.col("quotes") > 0, F.col("quotes")), 4)
    rates = one.select("*", rate("exact", "substring", "normalized", "no_offset_hit", "no_offset_norm").alias("verified_rate"), rate("exact").alias("exact_rate"), rate("miss", "no_offset_miss").alias("unlocated_rate"))
    return rates.join(F.broadcast(first))  # one row each


def derivation_stats(quotes: DataFrame, spans: DataFrame) -> DataFrame:
    """One row: quotes with text, how many of them were located and by which method, and the rate; null of none."""
    n = quotes.agg(F.count_if(F.col("text").isNotNull()).alias("quotes"), F.count_if(F.col("text").isNull()).alias("unfetchable"))
    s = spans.agg(F.count(F.lit(1)).alias("located"), F.count_if(F.col("method") == "find").alias("by_find"), F.count_if(F.col("method") == "whitespace").alias("by_whitespace"))
    return n.join(s).select("*", (F.col("quotes") - F.col("located")).alias("unlocated"), F.round(F.col("located") / F.when(F.col("quotes") > 0, F.col("quotes")), 4).alias("located_rate"))
