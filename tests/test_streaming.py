import pytest
from pyspark.sql import functions as F

from lakeloom.operators.presence import read_batches
from lakeloom.operators.versioned import read_table
from lakeloom.streaming import ingest as I
from tests.conftest import rows

SCHEMA = "k int, v string, ts timestamp"


def land(spark, folder, data):
    df = spark.createDataFrame([(k, v, f"2025-05-01 {h:02d}:00:00") for k, v, h in data], "k int, v string, ts string")
    df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(folder))


def kept(spark, path):
    return rows(spark.read.parquet(str(path)).select("k", "v"))


def test_merge_stream_over_runs(spark, tmp_path):
    landed, target, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")

    def run():
        stream = I.landing_stream(spark, str(landed), SCHEMA)
        I.merge_stream(stream, target, marks, ["k"], ["ts"]).awaitTermination()

    land(spark, landed, [(1, "a", 1), (1, "b", 2), (2, "c", 1)])
    run()
    assert kept(spark, target) == [(1, "b"), (2, "c")]
    run()  # nothing new
    assert kept(spark, target) == [(1, "b"), (2, "c")]
    land(spark, landed, [(2, "d", 5), (3, "e", 5)])
    run()
    assert kept(spark, target) == [(1, "b"), (2, "d"), (3, "e")]


def test_merge_stream_into_buckets(spark, tmp_path):
    landed, target, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    land(spark, landed, [(1, "a", 1), (1, "b", 2), (2, "c", 1)])
    land(spark, landed, [(2, "d", 5), (3, "e", 5)])
    stream = I.landing_stream(spark, str(landed), SCHEMA, files_per_batch=1)
    for checkpoint in (marks, marks, f"{tmp_path}/fresh"):  # nothing new, then all of it again
        I.merge_stream(stream, target, checkpoint, ["k"], ["ts"], buckets=4).awaitTermination()
        assert rows(read_table(spark, target).select("k", "v")) == [(1, "b"), (2, "d"), (3, "e")]
    with pytest.raises(ValueError, match="buckets or partitions"):
        I.merge_stream(stream, target, marks, ["k"], ["ts"], ["k"], buckets=4)


def test_append_stream_over_runs(spark, tmp_path):
    landed, target, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")

    def run(checkpoint=marks):
        stream = I.landing_stream(spark, str(landed), SCHEMA)
        I.append_stream(stream, target, checkpoint, ["k"], [F.col("ts")]).awaitTermination()

    land(spark, landed, [(1, "a", 1), (1, "b", 2), (None, "n", 1), (None, "n", 1)])
    run()
    assert kept(spark, target) == [(1, "a"), (None, "n"), (None, "n")]
    land(spark, landed, [(1, "late", 3), (2, "c", 3)])
    run()
    assert kept(spark, target) == [(1, "a"), (2, "c"), (None, "n"), (None, "n")]


def test_replayed_batch_appends_nothing(spark, tmp_path):
    landed, target = tmp_path / "in", str(tmp_path / "out")
    land(spark, landed, [(1, "a", 1), (2, "b", 1), (None, "n", 1)])
    for attempt in range(2):  # a fresh checkpoint plays batch 0 again
        stream = I.landing_stream(spark, str(landed), SCHEMA)
        I.append_stream(stream, target, str(tmp_path / f"marks{attempt}"), ["k"], ["ts"]).awaitTermination()
    assert kept(spark, target) == [(1, "a"), (2, "b"), (None, "n")]


def test_indexed_stream(spark, tmp_path):
    """Repeats in the same micro-batch, in a later one, and played again."""
    landed, target, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    for some in ([(1, "a", 1), (1, "b", 2), (None, "n", 1)], [(1, "late", 3), (2, "c", 3)], [(2, "d", 4), (3, "e", 4), (None, "n", 1)]):
        land(spark, landed, some)
    for checkpoint in (marks, marks, f"{tmp_path}/fresh"):
        stream = I.landing_stream(spark, str(landed), SCHEMA, files_per_batch=1)
        I.indexed_stream(stream, target, checkpoint, ["k"], [F.col("ts")]).awaitTermination()
        assert rows(read_batches(spark, target).select("k", "v")) == [(1, "a"), (2, "c"), (3, "e"), (None, "n")]


@pytest.mark.parametrize("spread", [(), ("v",)])
def test_without_repeats(spark, tmp_path, spread):
    landed, target, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    land(spark, landed, [(1, f"v{i}", i % 20) for i in range(200)] + [(2, "x", 3)])
    land(spark, landed, [(1, "again", 4), (3, "y", 4)])
    stream = I.landing_stream(spark, str(landed), SCHEMA, files_per_batch=1)
    once = I.without_repeats(stream, ["k"], "ts", "2 days", spread)
    I.write_stream(once, target, marks).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [1, 2, 3]
