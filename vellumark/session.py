"""Session helpers shared by every operator: table access and lineage cutting."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def build_session(cpus: int | str = 8, app: str = "vellumark") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(os.cpu_count() if cpus == "*" else cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VELLUMARK_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python stages find it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="vellumark-package-")) / "vellumark.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def on_workers(df: DataFrame) -> DataFrame:
    """df, whose executors have this package: what every stage in Python begins with."""
    ship(df.sparkSession)
    return df


def worker_udf(returns: DataType) -> Callable[[Callable], Callable[..., Column]]:
    """A pandas function over columns that gives the executors this package when it is used."""

    def wrap(f: Callable) -> Callable[..., Column]:
        udf = F.pandas_udf(f, returns)

        def call(*columns: Column) -> Column:
            if (spark := SparkSession.getActiveSession()) is not None:
                ship(spark)
            return udf(*columns)

        return call

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the archive's tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only in a local session, where there is one machine."""
    sc = spark.sparkContext
    if shared := spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir"):
        return shared
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="vellumark-checkpoint-")


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(spark))


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and forget its lineage.

    The folder is the session's spark.checkpoint.dir; without one a local session gets a temporary folder
    and any other is refused. Files go with their table where spark.cleaner.referenceTracking.cleanCheckpoints
    is set, as build_session does. Survives the loss of executors, unlike a local checkpoint.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    ship(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files give fewer partitions than there are cores, else as it is.

    For narrow stages whose work per row far outweighs moving the row.
    """
    ship(df.sparkSession)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
