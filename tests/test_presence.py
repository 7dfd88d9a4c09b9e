"""Indexed appends against the anti join, and price summaries against measures over all ticks."""

import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import presence, summaries
from lakeloom.operators.merge import new_rows
from lakeloom.operators.windows import price_movement
from tests.conftest import rows


def load(spark, rng, size, low, high):
    return spark.createDataFrame(
        [(rng.choice([None, *range(low, high)]) if size < 100 else rng.randrange(low, high), f"v{rng.randrange(9)}") for _ in range(size)],
        "k long, v string",
    )


def test_equal_to_the_anti_join(spark, tmp_path):
    rng, path = random.Random(2), str(tmp_path)
    stored = None
    for n, (size, low, high) in enumerate([(400, 0, 300), (30, 250, 350), (60, 1000, 1100)]):
        batch = load(spark, rng, size, low, high)
        added = rows(presence.append_indexed(batch, path, f"b{n}", ["k"], keys_per_bitmap=64))
        again = rows(presence.append_indexed(batch, path, f"b{n}", ["k"], keys_per_bitmap=64))
        assert again == added
        expected = batch if stored is None else new_rows(stored, batch, ["k"])
        keyless = [] if stored is None else [r.v for r in stored.where("k is null").collect()]  # these pass once
        assert added == [r for r in rows(expected) if r[0] is not None or r[1] not in keyless]
        whole = presence.read_batches(spark, path)
        stored = spark.createDataFrame(whole.drop("batch").collect(), "k long, v string")
    assert presence.batches(spark, path) == ["b0", "b1", "b2"]


def test_reads_named_batches_only(spark, tmp_path):
    path = str(tmp_path)
    for n in range(5):
        presence.append_indexed(spark.range(1000 * n, 1000 * n + 500).selectExpr("id k"), path, f"b{n}", ["k"])
    asked = spark.createDataFrame([(3007,), (9999,), (None,)], "k long")
    index = spark.read.parquet(*[f"{path}/presence/batch=b{n}" for n in range(5)]).withColumn(
        "batch", F.regexp_extract("_metadata.file_path", "/batch=([^/]+)/", 1)
    )
    assert {r.batch for r in presence.may_hold(index, asked, ["k"]).where("k = 3007").collect()} >= {"b3"}
    found = presence.stored_among(spark, path, [f"b{n}" for n in range(5)], asked, ["k"])
    assert rows(found) == [(3007,)]
    read = {f.split("rows/")[1].split("/")[0] for f in found.inputFiles() if "rows/" in f}
    assert read == {"batch=b3"}


def test_keys_that_only_seem_to_be_there(spark, tmp_path):
    """One bitmap for far too many keys: most of its bits are set, and the rows decide."""
    path = str(tmp_path)
    presence.append_indexed(spark.range(0, 60_000, 2).selectExpr("id k"), path, "even", ["k"], keys_per_bitmap=10**6)
    odd = spark.range(1, 2001, 2).selectExpr("id k")
    index = spark.read.parquet(f"{path}/presence/batch=even").withColumn("batch", F.lit("even"))
    assert presence.may_hold(index, odd, ["k"]).count() > 500
    assert presence.append_indexed(odd, path, "odd", ["k"]).count() == 1000


def test_a_batch_that_was_not_finished_does_not_count(spark, tmp_path):
    path = str(tmp_path)
    presence.append_indexed(spark.range(5).selectExpr("id k"), path, "a", ["k"])
    spark.range(5, 9).selectExpr("id k").write.parquet(f"{path}/rows/batch=b")
    assert presence.read_batches(spark, path).count() == 5
    assert presence.append_indexed(spark.range(4, 9).selectExpr("id k"), path, "b", ["k"]).count() == 4
    assert presence.append_indexed(spark.range(0).selectExpr("id k"), path, "c", ["k"]).count() == 0
    with pytest.raises(ValueError, match="plain name"):
        presence.append_indexed(spark.range(1).selectExpr("id k"), path, "a/b", ["k"])


def test_prices_over_batches(spark, tmp_path):
    """Any split into batches, late ticks and ticks without time, id or stock included."""
    rng, path = random.Random(4), str(tmp_path)
    schema = "id long, stock string, price double, datetime timestamp"
    so_far = spark.createDataFrame([], schema)
    given = []
    for batch in range(4):
        ticks = [
            (100 * batch + i if rng.random() < 0.95 else None, rng.choice(["a", "b", None]), round(rng.random() * 100, 2),
             rng.choice([None, *range(50)]))
            for i in range(25)
        ]
        given += ticks
        frame = spark.createDataFrame(ticks, "id long, stock string, price double, at long").select(
            "id", "stock", "price", F.timestamp_seconds("at").alias("datetime")
        )
        so_far = so_far.union(frame)
        got = summaries.append_measured(frame, path, f"{batch}", fold_at=2)
        expected = price_movement(so_far).join(frame.select("id").where("id is not null"), "id", "left_semi")
        assert rows(got.where("id is not null")) == rows(expected)
    assert summaries._folds(spark, path)
