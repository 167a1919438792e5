"""Filling fixed-capacity containers with items (problem 4).

Shortest-pack-first over the histogram of lengths. The histogram has at most `capacity` bins whatever the
number of items, so the plan is made on the driver; placing the items is one join by length and rank.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Mapping
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import with_group_rank

#: Above so many placements the table of them is joined by shuffle instead of broadcast.
BROADCAST_PLACEMENTS = 200_000

Placement = tuple[int, int, int, int, int]


def pack_histogram(histogram: Mapping[int, int], capacity: int) -> list[Placement]:
    """Placements (length, first_rank, last_rank, first_batch, per_batch) of a histogram {length: items}.

    Lengths are taken longest first. Packs alike are kept as one pattern with a count; a length goes to the
    pattern with the most room left (the shortest pack), as many times as fit; the pattern is split where
    the items end. Where no pack has room new packs are opened, each with as many of the length as fit.
    Items of rank first_rank..last_rank of a length go to batches first_batch, first_batch + 1, ...,
    per_batch to each. Every length must lie in 1..capacity.
    """
    room: list[tuple[int, int, int, int]] = []  # (-room, tie, first batch, packs): batches are numbered consecutively in a pattern
    placed: list[Placement] = []
    ties, batches = count(), 0
    for length in sorted(histogram, reverse=True):
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        left, rank = histogram[length], 0
        while left > 0:
            if room and -room[0][0] >= length:
                free, _, first, packs = heapq.heappop(room)
                free = -free
                # Shortest pack first: one item each, so that packs fill evenly; more at once only where there are items for all.
                each = max(1, min(free // length, left // packs)) if left >= packs else 1
                use = min(packs, left // each)
            else:
                free, each = capacity, min(capacity // length, left)
                use = packs = left // each
                first, batches = batches, batches + packs
            placed.append((length, rank, rank + use * each - 1, first, each))
            rank, left = rank + use * each, left - use * each
            heapq.heappush(room, (-(free - each * length), next(ties), first, use))
            if use < packs:
                heapq.heappush(room, (-free, next(ties), first + use, packs - use))
    return placed


def pack_items(items: DataFrame, capacities: DataFrame, keys: tuple[str, ...] = ("doc_id", "seq"), length: str = "tokens", name: str = "pass_name", capacity: str = "capacity_tokens") -> DataFrame:
    """Batches of items for each capacity: (name, *keys, piece int, tokens bigint, batch bigint).

    An item is taken once per key (of repeated rows the largest length); lengths null, zero or negative are
    left out, as are null or non-positive capacities. An item above the capacity is cut into full pieces
    and a rest; nothing else is cut. Empty inputs give an empty table. Only the named columns are read, so
    extra columns and their names don't matter. `capacities` is a small fixed table; each of its rows
    costs one pass over the items.
    """
    spark: SparkSession = items.sparkSession
    sizes = {r[0]: int(r[1]) for r in capacities.where(F.col(capacity) > 0).select(name, capacity).distinct().orderBy(name, capacity).collect()}
    kinds = [items.schema[k] for k in keys]
    if not sizes:
        return spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType()), *kinds, T.StructField("piece", T.IntegerType()), T.StructField(length, T.LongType()), T.StructField("batch", T.LongType())]))
    usable = items.where(F.col(length) > 0).groupBy(*keys).agg(F.max(length).cast("bigint").alias(length))
    limits = F.array(*[F.struct(F.lit(n).alias(name), F.lit(c).cast("bigint").alias("__capacity")) for n, c in sizes.items()])
    each = usable.select("*", F.inline(limits))
    pieces = (
        each.withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col(length) / F.col("__capacity")).cast("int") - 1)))
        .withColumn(length, F.least(F.col("__capacity"), F.col(length) - F.col("__capacity") * F.col("piece")))
        .select(name, *keys, "piece", length)
    )
    histograms: dict[str, dict[int, int]] = defaultdict(dict)
    for n, size, many in pieces.groupBy(name, length).agg(F.count(F.lit(1))).collect():  # at most sum(capacities) rows
        histograms[n][size] = many
    placements = [(n, *p) for n in sorted(histograms) for p in pack_histogram(histograms[n], sizes[n])]
    plan = spark.createDataFrame(placements, f"{name} string, {length} bigint, __first bigint, __last bigint, __batch bigint, __each bigint")
    plan = plan.groupBy(name, length).agg(F.array_sort(F.collect_list(F.struct("__first", "__last", "__batch", "__each"))).alias("__plan"))
    if len(placements) <= BROADCAST_PLACEMENTS:
        plan = F.broadcast(plan)
    ranked = with_group_rank(pieces, [name, length], [*keys, "piece"])
    chosen = F.filter("__plan", lambda p: (p["__first"] <= F.col("rank")) & (F.col("rank") <= p["__last"]))[0]
    return (
        ranked.join(plan, [name, length])
        .withColumn("__p", chosen)
        .select(name, *keys, "piece", length, (F.col("__p.__batch") + F.floor((F.col("rank") - F.col("__p.__first")) / F.col("__p.__each"))).cast("bigint").alias("batch"))
    )


def fill_report(batches: DataFrame, capacities: DataFrame) -> DataFrame:
    """(pass_name, batches, items, tokens, fill double) per capacity: the share of the space that is used."""
    per = batches.groupBy("pass_name", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    total = per.groupBy("pass_name").agg(F.count(F.lit(1)).alias("batches"), F.sum("n").alias("items"), F.sum("t").alias("tokens"))
    small = capacities.select("pass_name", "capacity_tokens").distinct()
    return total.join(small, "pass_name").select("pass_name", "batches", "items", "tokens", F.round(F.col("tokens") / (F.col("batches") * F.col("capacity_tokens")), 6).alias("fill"))
