"""Indexes that grow with their input: only new files are read, and a rerun changes nothing."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import first_per_key, insert_new, last_per_key, upsert
from ..session import shared_folder

BUCKETS = 64


def hourly_counts(spark: SparkSession, path: str, folder: str | None = None, late: str = "30 days") -> DataFrame:
    """(event_type, window_start, n, total) of an event stream, by hour; all there is is read, then the stream rests.

    Windows that a batch changed are merged into a keyed index below `folder`, which a later call with the
    same folder carries on. Events later than `late` behind the newest of earlier batches are dropped.
    """
    events = stream_of(spark, path).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = events.withWatermark("ts", late).groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    rows = counts.select("event_type", F.col("w.start").alias("window_start"), "n", "total")
    folder = folder or f"{shared_folder(spark)}/hourly-{uuid.uuid4().hex}"
    keep_index(rows, f"{folder}/index", f"{folder}/stream", ["n"], ("event_type", "window_start"), mode="update")
    whole = read_index(spark, f"{folder}/index")
    whole = whole if whole is not None else spark.createDataFrame([], rows.schema)
    return whole.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("total", 4).alias("total"))


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the Parquet files at a path; a single file is watched through its folder and a name filter."""
    parent, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.parquet(path) if _is_folder(spark, path) else reader.option("pathGlobFilter", name).parquet(parent)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).isDirectory()


def keep_index(source: DataFrame, target: str, checkpoint: str, order: Sequence[str], keys: tuple[str, ...] = ("doc_id", "seq"), last_wins: bool = True, buckets: int = BUCKETS, mode: str = "append") -> None:
    """Bring a keyed Parquet index up to date with a streaming source: each batch is merged by key.

    Of the rows of a key in one batch the last in `order` counts, or the first where `last_wins` is off; over
    batches the later batch does, or the earlier. Keys are hashed into buckets and only buckets that a batch
    touches are written anew, beside the old ones. A pointer file names the files of each bucket and is
    replaced in one rename, so readers see whole versions only, and a batch that is run again after a failure
    gives the same index.
    """
    spark = source.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        rows = (last_per_key if last_wins else first_per_key)(batch, keys, order).withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        rows = rows.persist()
        touched = sorted(r[0] for r in rows.select("__bucket").distinct().collect())  # at most `buckets` numbers
        if touched:
            state = _pointer(spark, target) or {"buckets": {}, "schema": batch.schema.json()}
            paths = [state["buckets"][str(t)] for t in touched if str(t) in state["buckets"]]
            merged = rows
            if paths:
                old = spark.read.schema(rows.drop("__bucket").schema).parquet(*[f"{target}/{p}" for p in paths]).withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
                merged = upsert(old, rows, order, keys) if last_wins else insert_new(old, rows, order, keys)
            version = f"v{number:09d}-{uuid.uuid4().hex[:8]}"
            merged.repartition("__bucket").write.partitionBy("__bucket").parquet(f"{target}/{version}")
            state["buckets"] |= {str(t): f"{version}/__bucket={t}" for t in touched}
            _replace(spark, f"{target}/current", json.dumps(state))
        rows.unpersist()

    source.writeStream.foreachBatch(merge).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_index(spark: SparkSession, target: str) -> DataFrame | None:
    """The index's current version, None before the first."""
    from pyspark.sql.types import StructType

    state = _pointer(spark, target)
    if state is None:
        return None
    return spark.read.schema(StructType.fromJson(json.loads(state["schema"]))).parquet(*[f"{target}/{p}" for p in state["buckets"].values()])


def _pointer(spark: SparkSession, target: str) -> dict | None:
    fs, p = _fs(spark, f"{target}/current")
    return json.loads(spark.read.text(f"{target}/current", wholetext=True).first()[0]) if fs.exists(p) else None


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old one or the new one, never none."""
    fs, new = _fs(spark, f"{path}.new")
    out = fs.create(new, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(new, jvm.org.apache.hadoop.fs.Path(path), options)
