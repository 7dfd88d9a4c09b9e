import pytest
from pyspark.sql import functions as F

from lakeloom.operators import joins, merge
from tests.conftest import plan_text, rows

NEWEST = ["seq"]


def frame(spark, data, schema="k int, v string, seq int"):
    return spark.createDataFrame(data, schema)


def test_merge_by_key(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 1), (None, "n", 1)])
    updates = frame(spark, [(2, "old", 2), (2, "new", 3), (3, "c", 2), (None, "m", 2)])
    got = merge.merge_by_key(target, updates, ["k"], NEWEST)
    assert rows(got) == sorted([(1, "a", 1), (2, "new", 3), (3, "c", 2), (None, "n", 1), (None, "m", 2)], key=repr)


def test_merge_first_run_and_new_column(spark):
    first = merge.merge_by_key(None, frame(spark, [(1, "a", 1), (1, "b", 2)]), ["k"], NEWEST)
    assert rows(first) == [(1, "b", 2)]
    wide = frame(spark, [(2, "c", 3, True)], "k int, v string, seq int, extra boolean")
    assert rows(merge.merge_by_key(first, wide, ["k"], NEWEST)) == [(1, "b", 2, None), (2, "c", 3, True)]


def test_ties_are_settled_the_same_way(spark):
    data = [(1, f"v{i}", 1) for i in range(50)]
    got = {
        rows(merge.latest_per_key(frame(spark, data[i:] + data[:i]), ["k"], NEWEST))[0] for i in range(0, 50, 10)
    }
    assert len(got) == 1


def test_repeated_keys_are_limited_before_the_shuffle(spark):
    text = plan_text(merge.latest_per_key(frame(spark, [(1, "a", 1)]), ["k"], NEWEST))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_new_rows(spark):
    source = frame(spark, [(1, "a", 1), (2, "b", 1), (None, "n", 1)])
    target = frame(spark, [(2, "stored", 0), (None, "stored", 0)])
    assert rows(merge.new_rows(target, source, ["k"])) == [(1, "a", 1), (None, "n", 1)]
    assert merge.new_rows(None, source, ["k"]).count() == 3


def test_rows_without_key_are_spread(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    many = spark.range(4000).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v"))
    got = joins.anti_join(many, spark.range(5).select(F.col("id").alias("k")), ["k"])
    assert got.count() == 4000
    sizes = [n for n in got.rdd.glom().map(len).collect()]
    assert max(sizes) < 2000, sizes


def test_repeated_keys_are_grouped_by_the_join_keys(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.createDataFrame([(1,), (None,)], "k int")
    text = plan_text(joins.anti_join(left, left, ["k"], repeated=True))
    assert text.count("Exchange hashpartitioning(k") == 2  # one per side


def test_anti_join_over_two_keys(spark):
    left = spark.createDataFrame([(1, 1), (1, 2), (1, None), (None, None)], "a int, b int")
    right = spark.createDataFrame([(1, 1), (1, 1), (1, None)], "a int, b int")
    assert rows(joins.anti_join(left, right, ["a", "b"], repeated=True)) == sorted([(1, 2), (1, None), (None, None)], key=repr)


def test_upsert_table_over_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    keys, schema = ["y", "k"], "y int, k int, v string, seq int"
    runs = [
        [(2023, 1, "a", 1), (2024, 1, "b", 1), (None, 9, "n", 1)],
        [(2024, 1, "B", 2), (2024, 2, "c", 2), (2024, 2, "d", 3)],
        [(2025, 1, "e", 4), (None, 9, "m", 4)],
    ]
    for run in runs:
        merge.upsert_table(frame(spark, run, schema), path, keys, NEWEST, ["y"])
    want = sorted(
        [(2023, 1, "a", 1), (2024, 1, "B", 2), (2024, 2, "d", 3), (2025, 1, "e", 4), (None, 9, "n", 1), (None, 9, "m", 4)],
        key=repr,
    )
    cols = ["y", "k", "v", "seq"]
    assert rows(spark.read.parquet(path).select(cols)) == want
    # the same updates again change nothing (a row without a full key has no identity)
    merge.upsert_table(frame(spark, runs[1], schema), path, keys, NEWEST, ["y"])
    assert rows(spark.read.parquet(path).select(cols)) == want


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = tmp_path / "t"
    schema = "y int, k int, v string, seq int"
    merge.upsert_table(frame(spark, [(2023, 1, "a", 1), (2024, 1, "b", 1)], schema), str(path), ["y", "k"], NEWEST, ["y"])
    before = {p.name for p in (path / "y=2023").glob("*.parquet")}
    merge.upsert_table(frame(spark, [(2024, 1, "c", 2)], schema), str(path), ["y", "k"], NEWEST, ["y"])
    assert {p.name for p in (path / "y=2023").glob("*.parquet")} == before
    assert rows(spark.read.parquet(str(path)).select("y", "v")) == [(2023, "a"), (2024, "c")]


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "y int, c string, k int, v string, seq int"
    data = [(y, c, 1, "a", 1) for y in (2023, 2024, None) for c in ("1", "2")]
    merge.upsert_table(frame(spark, data, schema), path, ["y", "c", "k"], NEWEST, ["y", "c"])
    updates = frame(spark, [(None, "1", 1, "n", 2), (2024, "2", 1, "b", 2)], schema)
    rest = merge._touched_partitions(spark.read.parquet(path), updates, ["y", "c"])
    assert rows(rest.select("y", "c")) == [(2024, "2"), (None, "1")]
    assert "PartitionFilters: [" in plan_text(rest) and "y#" in plan_text(rest).split("PartitionFilters: [")[1].split("]")[0]
    merge.upsert_table(updates, path, ["y", "c", "k"], NEWEST, ["y", "c"])
    got = rows(spark.read.parquet(path).selectExpr("y", "string(c)", "v"))
    assert got == sorted(
        [(2023, "1", "a"), (2023, "2", "a"), (2024, "1", "a"), (2024, "2", "b"), (None, "1", "a"), (None, "1", "n"), (None, "2", "a")],
        key=repr,
    )


def test_some_partitions_of_a_span_are_touched(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "y int, k int, v string, seq int"
    merge.upsert_table(frame(spark, [(y, 1, "a", 1) for y in range(4)], schema), path, ["y", "k"], NEWEST, ["y"])
    merge.upsert_table(frame(spark, [(y, 1, "b", 2) for y in range(2)], schema), path, ["y", "k"], NEWEST, ["y"])
    assert rows(spark.read.parquet(path).select("y", "v")) == [(0, "b"), (1, "b"), (2, "a"), (3, "a")]


def test_new_rows_of_a_small_batch_do_not_shuffle_the_target(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(str(tmp_path / "target"))
    spark.range(95, 105).select(F.col("id").alias("k"), F.lit("y").alias("v")).write.parquet(str(tmp_path / "batch"))
    target, batch = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "batch"))
    got = merge.new_rows(target, batch, ["k"], few=True)
    assert rows(got.select("k")) == [(k,) for k in range(100, 105)]
    text = plan_text(merge.new_rows(target, batch, ["k"], few=True))
    assert "LeftSemi, BuildRight" in text and "SortMergeJoin" not in text


def test_upsert_without_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for run in ([(1, "a", 1)], [(1, "b", 2), (2, "c", 2)], [(1, "b", 2)]):
        merge.upsert_table(frame(spark, run), path, ["k"], NEWEST)
    assert rows(spark.read.parquet(path)) == [(1, "b", 2), (2, "c", 2)]


def test_partitions_must_belong_to_the_key(spark, tmp_path):
    with pytest.raises(ValueError, match="part of the merge key"):
        merge.upsert_table(frame(spark, [(1, "a", 1)]), str(tmp_path), ["k"], NEWEST, ["v"])


def test_append_new_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.append_new(frame(spark, [(1, "a", 1)]), path, ["k"])
    batch = frame(spark, [(1, "changed", 2), (2, "b", 2)])
    merge.append_new(batch, path, ["k"])
    merge.append_new(batch, path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "b", 2)]


@pytest.mark.parametrize("partition_by", [[], ["y"]])
@pytest.mark.parametrize("dies", ["before the table is touched", "with the table emptied", "after the write"])
def test_an_interrupted_merge_loses_nothing(spark, tmp_path, monkeypatch, partition_by, dies):
    path, schema, keys = str(tmp_path / "t"), "y int, k int, v string, seq int", ["y", "k"]
    first = [(2020 + i % 3, i, "a", 1) for i in range(100)] + [(None, 7, "n", 1)]
    batch = frame(spark, [(2020, 0, "b", 2), (2021, 500, "c", 2), (None, 8, "m", 2)], schema)
    merge.upsert_table(frame(spark, first, schema), path, keys, NEWEST, partition_by)
    whole = merge._overwrite

    def broken(merged, at, by):
        if dies == "with the table emptied":
            for file in (tmp_path / "t").rglob("*.parquet"):
                file.unlink()
        if dies == "after the write":
            whole(merged, at, by)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(merge, "_overwrite", broken)
    if dies == "with the table emptied" and partition_by:  # only partitions that are written go
        touched = tmp_path / "t" / "y=2020"

        def broken(merged, at, by):  # noqa: F811
            for file in touched.glob("*.parquet"):
                file.unlink()
            raise RuntimeError("executor lost")

        monkeypatch.setattr(merge, "_overwrite", broken)
    with pytest.raises(RuntimeError, match="lost"):
        merge.upsert_table(batch, path, keys, NEWEST, partition_by)
    monkeypatch.setattr(merge, "_overwrite", whole)
    for _ in range(2):  # the call is repeated, and its batch replayed
        merge.upsert_table(batch, path, keys, NEWEST, partition_by)
    want = {r[1]: r for r in first if r[0]} | {0: (2020, 0, "b", 2), 500: (2021, 500, "c", 2)}
    want = [*want.values(), (None, 7, "n", 1), (None, 8, "m", 2)]
    got = spark.read.parquet(path).select("y", "k", "v", "seq")
    assert rows(got) == sorted(want, key=repr)
    assert not (tmp_path / "t__pending").exists()


def test_replays_do_not_multiply_rows_without_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = frame(spark, [(None, "n", 1), (1, "a", 1)])
    for _ in range(3):
        merge.append_new(batch, path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (None, "n", 1)]


def test_rows_with_maps_can_be_ranked(spark):
    df = spark.createDataFrame([(1, {"a": 1}, 1), (1, {"a": 2}, 1)], "k int, m map<string,int>, seq int")
    assert merge.latest_per_key(df, ["k"], NEWEST).count() == 1


def test_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.replace_table(frame(spark, [(1, "a", 1)]), path)
    merge.replace_table(frame(spark, [(2, "b", 1)]), path)
    assert rows(spark.read.parquet(path)) == [(2, "b", 1)]


def test_lookup_splits_a_hot_key(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    facts = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    table = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = joins.lookup(facts, table, "k")
    got.write.format("noop").mode("overwrite").save()
    assert got.count() == 60_000
    rerun = joins.lookup(facts, table, "k")
    rerun.collect()
    assert "skew=true" in plan_text(rerun)
