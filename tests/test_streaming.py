import pytest
from pyspark.sql import functions as F

from vellumark.streaming.incremental import hourly_counts, keep_index, read_index


def test_index_grows_and_reruns_change_nothing(spark, tmp_path):
    src, target, mark = (str(tmp_path / n) for n in ("src", "index", "mark"))
    schema = "doc_id string, seq int, v int"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    run = lambda: keep_index(spark.readStream.schema(schema).parquet(src), target, mark, ["v"])
    assert read_index(spark, target) is None
    put([("a", 0, 1), ("b", 0, 2)])
    run()
    put([("b", 0, 3), ("c", 0, 4)])
    run()
    run()
    assert sorted((r[0], r[2]) for r in read_index(spark, target).select("doc_id", "seq", "v").collect()) == [("a", 1), ("b", 3), ("c", 4)]


@pytest.mark.parametrize("last_wins", [True, False])
def test_one_row_counts_inside_a_batch_and_over_batches(spark, tmp_path, last_wins):
    src, target, mark = (str(tmp_path / n) for n in ("src", "index", "mark"))
    schema = "doc_id string, seq int, v int"
    for first in (0, 100):
        spark.createDataFrame([(f"d{k}", 0, first + i) for k in range(20) for i in range(30)], schema).repartition(4).write.mode("append").parquet(src)
        keep_index(spark.readStream.schema(schema).parquet(src), target, mark, ["v"], last_wins=last_wins, buckets=4)
    assert {tuple(r) for r in read_index(spark, target).select("doc_id", "v").collect()} == {(f"d{k}", 129 if last_wins else 0) for k in range(20)}
    assert [p.name for p in (tmp_path / "index").iterdir() if p.name.startswith("current")] == ["current"]


def test_counts_go_on(spark, tmp_path):
    src, keep = str(tmp_path / "events"), str(tmp_path / "keep")
    put = lambda rows: spark.createDataFrame(rows, "event_type string, at int, value double").withColumn("ts", F.timestamp_seconds("at").cast("timestamp_ntz")).drop("at").write.mode("append").parquet(src)
    put([("a", 10, 1.0), ("a", 20, 2.0), ("b", 4_000, 5.0)])
    hourly_counts(spark, src, keep)
    put([("a", 30, 4.0)])
    assert {(r["event_type"], r["n"], r["total"]) for r in hourly_counts(spark, src, keep).collect()} == {("a", 3, 7.0), ("b", 1, 5.0)}
