"""Bucketed, versioned tables: equal to the plain merge, readable at any moment."""

import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import merge, versioned
from lakeloom.session import subfolders
from tests.conftest import rows

KEYS, NEWEST = ["k", "d"], ["seq"]
COLUMNS = "k long, d string, v string, seq long"


def batch(spark, rng, size, keys=60):
    values = [
        (rng.choice([None, *range(keys)]), rng.choice(["a", "b", None]), rng.choice("xyz"), rng.randrange(1000))
        for _ in range(size)
    ]
    return spark.createDataFrame(values, COLUMNS)


def test_equal_to_the_plain_merge(spark, tmp_path):
    rng = random.Random(1)
    ours, plain = str(tmp_path / "ours"), str(tmp_path / "plain")
    for n in (80, 0, 30):
        some = batch(spark, rng, n)
        for _ in range(2):  # a load that is done again changes nothing
            versioned.merge_table(some, ours, KEYS, NEWEST, buckets=8)
            merge.upsert_table(some, plain, KEYS, NEWEST)
            assert rows(versioned.read_table(spark, ours)) == rows(spark.read.parquet(plain))


def test_a_small_batch_writes_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    first = versioned.merge_table(spark.range(1000).selectExpr("id k", "'a' d", "'x' v", "id seq"), path, KEYS, NEWEST, buckets=32)
    assert set(first.loads) == set(range(32))
    small = spark.createDataFrame([(5, "a", "new", 1), (2000, "a", "new", 1)], COLUMNS)
    second = versioned.merge_table(small, path, KEYS, NEWEST)
    changed = [b for b in second.loads if second.loads[b] != first.loads[b]]
    assert 1 <= len(changed) <= 2
    load = second.loads[changed[0]]
    assert len([f for f in subfolders(spark, f"{path}/rows/load={load}")]) == len(changed)
    written = spark.read.parquet(f"{path}/rows/load={load}").count()
    assert written < 2 * 1000 / 32 * 2.5
    table = versioned.read_table(spark, path)
    assert table.count() == 1001 and table.where("k = 5").head().v == "new"
    assert versioned.read_table(spark, path, 1).where("k = 5").head().v == "x"


def test_readers_see_whole_versions(spark, tmp_path, monkeypatch):
    """A load that dies in its last step, or before it, changes nothing for readers; done again it counts."""
    path = str(tmp_path / "t")
    versioned.merge_table(spark.createDataFrame([(1, "a", "x", 1), (2, "a", "x", 1)], COLUMNS), path, KEYS, NEWEST, buckets=4)
    before = versioned.read_table(spark, path)
    update = spark.createDataFrame([(1, "a", "y", 2), (3, "a", "y", 2)], COLUMNS)

    def dies(*_):
        raise KeyboardInterrupt

    for step in ("move_folder", "_enter"):
        with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
            patch.setattr(versioned, step, dies)
            versioned.merge_table(update, path, KEYS, NEWEST)
        assert rows(versioned.read_table(spark, path)) == rows(before) == [(1, "a", "x", 1), (2, "a", "x", 1)]
    versioned.merge_table(update, path, KEYS, NEWEST)
    assert rows(versioned.read_table(spark, path)) == [(1, "a", "y", 2), (2, "a", "x", 1), (3, "a", "y", 2)]
    assert rows(before) == [(1, "a", "x", 1), (2, "a", "x", 1)]  # a reader that began earlier goes on
    gone = versioned.remove_old_versions(spark, path, keep=1)
    assert gone >= 2 and versioned.versions(spark, path) == [2]
    assert rows(versioned.read_table(spark, path)) == [(1, "a", "y", 2), (2, "a", "x", 1), (3, "a", "y", 2)]


def test_the_later_of_two_loads_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versioned.merge_table(spark.createDataFrame([(1, "a", "x", 1)], COLUMNS), path, KEYS, NEWEST, buckets=4)
    real = versioned._enter

    def another_first(*given):
        monkeypatch.setattr(versioned, "_enter", real)
        versioned.merge_table(spark.createDataFrame([(2, "a", "first", 1)], COLUMNS), path, KEYS, NEWEST)
        real(*given)

    monkeypatch.setattr(versioned, "_enter", another_first)
    with pytest.raises(versioned.StaleVersion):
        versioned.merge_table(spark.createDataFrame([(1, "a", "late", 9)], COLUMNS), path, KEYS, NEWEST)
    assert rows(versioned.read_table(spark, path)) == [(1, "a", "x", 1), (2, "a", "first", 1)]


def test_columns_come_and_go(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.merge_table(spark.createDataFrame([(1, "a", "x", 1), (None, "a", "n", 1)], COLUMNS), path, KEYS, NEWEST, buckets=4)
    wide = spark.createDataFrame([(2, "a", 5, True), (None, "a", 1, None)], "k long, d string, seq long, more boolean")
    wide = wide.withColumn("v", F.when(F.col("k").isNull(), "n"))
    for _ in range(2):
        versioned.merge_table(wide.select("k", "d", "v", "seq", "more"), path, KEYS, NEWEST)
    assert rows(versioned.read_table(spark, path)) == [(1, "a", "x", 1, None), (2, "a", None, 5, True), (None, "a", "n", 1, None)]
    with pytest.raises(ValueError, match="kept by"):
        versioned.merge_table(wide, path, ["k"], NEWEST)
    with pytest.raises(LookupError):
        versioned.read_table(spark, str(tmp_path / "none"))


def test_rows_without_a_key_fill_no_single_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    made = spark.range(400).selectExpr("cast(null as long) k", "cast(id as string) d", "'v' v", "id seq")
    version = versioned.merge_table(made, path, KEYS, NEWEST, buckets=8)
    assert len(version.loads) == 8 and versioned.read_table(spark, path).count() == 400


def test_empty_first_load(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.merge_table(spark.createDataFrame([], COLUMNS), path, KEYS, NEWEST, buckets=4)
    assert versioned.read_table(spark, path).count() == 0
    versioned.merge_table(spark.createDataFrame([(1, "a", "x", 1)], COLUMNS), path, KEYS, NEWEST)
    assert versioned.read_table(spark, path).count() == 1
