"""Tolerant reading of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tolerant(rows: DataFrame, column: str, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """`keep` and the fields of a column's JSON objects; rows that hold anything else are left out."""
    parsed = rows.select(*keep, F.col(column).alias("__raw"), F.from_json(column, f"{schema}, __bad string", {"columnNameOfCorruptRecord": "__bad"}).alias("__r"))
    whole = F.try_parse_json("__raw").isNotNull() & F.col("__raw").rlike(r"^\s*\{")
    return parsed.where(whole & F.col("__r.__bad").isNull()).select(*keep, "__r.*").drop("__bad")


def read_keyed(spark: SparkSession, path: str, schema: str, keys: tuple[str, ...] = ("doc_id", "seq")) -> DataFrame:
    """Rows of JSON lines that have all keys; lines torn, foreign or without key are left out, a path that isn't there is empty."""
    names = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not names.getFileSystem(spark._jsc.hadoopConfiguration()).exists(names):
        return spark.createDataFrame([], schema)
    rows = tolerant(spark.read.text(path), "value", schema)
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows
