"""Ranks inside groups of any size without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

SLICES = 64


def with_group_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], rank: str = "rank", bucket: Column | None = None, slices: int = SLICES) -> DataFrame:
    """df with `rank`, 0-based and dense inside each group, as bigint.

    Rows are ordered by `bucket` (default: none), then by a hash slice of the `order` columns, then by
    those columns. Only one (group, bucket, slice) cell is sorted in a task: a group that holds a third of
    all rows is spread over buckets x slices cells, whose sizes are added up in a small table. `order`
    must tell rows apart; among rows equal in all of it the rank is arbitrary but still dense.
    """
    cells = df.withColumn("__b", bucket if bucket is not None else F.lit(0)).withColumn("__s", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    keys = [*group, "__b", "__s"]
    sizes = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__b", "__s").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    left = cells.withColumn("__inside", inside).alias("l")
    joined = left.join(starts.select(*keys, "__start").alias("r"), condition)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("r.__start") + F.col("l.__inside")).cast("bigint").alias(rank))


def with_sorted_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], rank: str = "rank") -> DataFrame:
    """df with `rank`, 0-based and dense inside each group in `order`, as bigint; nulls come first.

    Rows are cut into ranges of (group, order) of about equal size, so a group, or a single moment in which
    a third of all rows lie, is spread over as many tasks as its share asks for. The ranges come from a
    sample, so they are written down (`cut`) before they are counted. `order` must tell rows apart; among
    rows equal in all of it the rank is arbitrary but still dense.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(ranges, *group, *order).withColumn("__range", F.spark_partition_id()))
    ranked = _added_up(placed, group, ["__range"], F.lit(1), F.row_number().over(Window.partitionBy(*group, "__range").orderBy(*order)) - 1, rank)
    return ranked.drop("__range")


def _added_up(cells: DataFrame, group: Sequence[str], within: Sequence[str], each: Column, inside: Column, name: str) -> DataFrame:
    """cells with `inside` plus what the cells of its group before its own hold of `each`."""
    keys = [*group, *within]
    sums = cells.groupBy(*keys).agg(F.sum(each).alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy(*within).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return cells.withColumn("__inside", inside).join(starts, on).select(*cells.columns, (F.col("__start") + F.col("__inside")).cast("bigint").alias(name))


def with_group_prefix_sum(df: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[str], value: str, before: str = "before") -> DataFrame:
    """df with `before`: the sum of `value` over the rows of its group that come earlier, as bigint.

    Rows are ordered by `bucket`, then by `order`; `bucket` must not contradict the order wanted. With an
    empty `group` the sum runs over the whole table, still without gathering it: only one bucket is sorted
    in a task, and the buckets' sums are added up in a small table. Null values count as 0.
    """
    cells = df.withColumn("__b", bucket)
    keys = [*group, "__b"]
    sums = cells.groupBy(*keys).agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("__start", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = cells.withColumn("__inside", F.coalesce(F.sum(F.coalesce(F.col(value), F.lit(0))).over(inside), F.lit(0))).alias("l")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    joined = left.join(starts.select(*keys, "__start").alias("r"), condition)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("r.__start") + F.col("l.__inside")).cast("bigint").alias(before))
