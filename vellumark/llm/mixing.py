"""Mixing sources to target shares of all tokens (problem 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import with_group_rank


def plan_mix(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available, rate): copies expected of each document of a source.

    rate = share x total / available, never above max_repeats. Without `total_tokens` the total is the
    largest at which every source that has tokens reaches its share within its repeats. Shares are taken
    relative to the sum over sources that have tokens; the rest get rate 0. Small tables on both sides.
    """
    t = targets.where((F.col("target_share") > 0) & (F.col("max_repeats") > 0) & F.col("source").isNotNull())
    t = t.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    t = t.join(sizes, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    share = F.when(F.col("available") > 0, F.col("target_share"))
    whole = t.agg(F.sum(share).alias("__whole"), F.min(F.col("max_repeats") * F.col("available") / share).alias("__reach"))
    total = F.lit(total_tokens).cast("double") if total_tokens is not None else F.col("__reach") * F.col("__whole")
    rate = F.least(F.col("max_repeats").cast("double"), F.col("target_share") / F.col("__whole") * total / F.col("available"))
    return t.join(F.broadcast(whole)).select("source", "target_share", "max_repeats", "available", F.when(F.col("available") > 0, rate).otherwise(0.0).alias("rate"))


def mix_sources(docs: DataFrame, targets: DataFrame, seed: int = 20260, total_tokens: int | None = None, tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """Chosen documents with repeats: (source, key, tokens, copy int from 1), one row per use.

    Systematic sampling inside each source: documents in order of size have the prefix sum of their
    expected copies shifted by one random offset, and are emitted once per integer boundary crossed. No
    document is used more often than max_repeats, and taking them by size keeps each source's tokens near
    its share. Documents of no target source, without source or without tokens are never chosen; ties in
    size go by a hash of the key; repeated rows count as documents of their own; with no target or no
    documents the result is empty. The same seed gives the same choice at any number of partitions.
    """
    usable = docs.where((F.col(tokens) > 0) & F.col("source").isNotNull()).select("source", key, F.col(tokens).cast("bigint").alias(tokens))
    sizes = usable.groupBy("source").agg(F.sum(tokens).alias("available"))
    plan = plan_mix(sizes, targets, total_tokens).select("source", "max_repeats", "rate")
    # The plan has one row per target: a small fixed table, joined before ranking so that other sources cost nothing.
    wanted = usable.join(plan.where("rate > 0"), "source")
    # Buckets by size: exact below 4096 tokens, then 64 to each doubling, so their number is bounded by the logarithm of the largest text.
    bucket = F.when(F.col(tokens) < 4096, F.col(tokens)).otherwise(F.floor(F.log2(tokens) * 64) + 4096 - 12 * 64).cast("int")
    ranked = with_group_rank(wanted, ["source"], [key, tokens], bucket=bucket, slices=8)
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("rate") * (F.col("rank") + 1) + offset) - F.floor(F.col("rate") * F.col("rank") + offset)
    return (
        ranked.withColumn("__copies", F.least(copies.cast("int"), F.col("max_repeats")))
        .where("__copies > 0")
        .select("source", key, tokens, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("copy"))
    )


def mix_report(chosen: DataFrame, docs: DataFrame, targets: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(source, target_share, available, tokens_used, uses, share_reached double, most_repeats int) per target."""
    available = docs.where((F.col(tokens) > 0) & F.col("source").isNotNull()).groupBy("source").agg(F.sum(tokens).cast("bigint").alias("available"))
    used = chosen.groupBy("source").agg(F.sum(tokens).alias("tokens_used"), F.count(F.lit(1)).alias("uses"), F.max("copy").alias("most_repeats"))
    whole = used.agg(F.sum("tokens_used").alias("__all"))
    goal = targets.groupBy("source").agg(F.max("target_share").alias("target_share"))
    joined = goal.join(available, "source", "left").join(used, "source", "left").join(F.broadcast(whole))
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind).alias(c)
    return joined.select("source", "target_share", zero("available", "bigint"), zero("tokens_used", "bigint"), zero("uses", "bigint"), F.round(F.coalesce(F.col("tokens_used") / F.col("__all"), F.lit(0.0)), 6).alias("share_reached"), zero("most_repeats", "int"))
