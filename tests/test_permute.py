import itertools

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.permute import ordered_selections
from tests.conftest import plan_text, rows

NAMES = ["i1", "i2", "i3", "i4"]


def brute(data, depth):
    groups = {}
    for key, item, _ in data:
        if key is not None and item is not None:
            groups.setdefault(key, []).append(item)
    out = []
    for key, item, attr in data:
        others = [x for x in groups.get(key, []) if x != item] if item is not None else []
        take = min(depth - 1, len(others))
        for rest in itertools.permutations(others, take):
            out.append((key, attr, item, *rest, *[None] * (depth - 1 - take)))
    return sorted(out, key=repr)


DATA = [
    ("a", "x", "A"),
    ("a", "y", "A"),
    ("a", "z", "A2"),
    ("b", "x", "B"),
    ("c", None, "C"),
    ("c", "x", "C"),
    ("c", "y", "C"),
    (None, "x", "N"),
    (None, None, "N"),
    *[("big", f"i{n}", "G") for n in range(6)],
]


@pytest.mark.parametrize("depth", [2, 3, 4])
def test_equals_brute_force(spark, depth):
    df = spark.createDataFrame(DATA, "key string, item string, attr string")
    got = ordered_selections(df, "key", "item", NAMES[:depth], attrs=["attr"])
    assert got.columns == ["key", "attr", *NAMES[:depth]]
    assert rows(got) == brute(DATA, depth)


def test_equals_chained_joins(spark):
    df = spark.createDataFrame(DATA, "key string, item string, attr string")
    df.createOrReplaceTempView("items_of_keys")
    chained = spark.sql(
        """select a.key, a.attr, a.item, b.item, c.item from items_of_keys a
           left join items_of_keys b on a.key = b.key and a.item != b.item
           left join items_of_keys c on a.key = c.key and c.item not in (a.item, b.item)"""
    )
    assert rows(ordered_selections(df, "key", "item", NAMES[:3], attrs=["attr"])) == rows(chained)


def test_struct_items(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, None, "c")], "key int, id int, name string")
    df = df.withColumn("item", F.when(F.col("id").isNotNull(), F.struct("id", "name")))
    got = ordered_selections(df, "key", "item", ["i1", "i2"], attrs=["name"]).select("name", "i2.name")
    assert rows(got) == [("a", "b"), ("b", "a"), ("c", None)]


def test_no_joins_and_spread_ranges(spark):
    df = spark.createDataFrame(DATA, "key string, item string, attr string")
    text = plan_text(ordered_selections(df, "key", "item", NAMES))
    assert "Join" not in text
    assert "REPARTITION_BY_NUM" in text and "hashpartitioning(" in text
    assert text.count("Generate") == 2  # ranges and numbers, however many levels there are


def test_big_group_is_spread_evenly(spark):
    """60 items and 205 320 selections of three, in ranges of 500."""
    df = spark.range(60).selectExpr("'big' as key", "id as item")
    got = ordered_selections(df, "key", "item", NAMES[:3], spread=16, selections=500)
    each = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    sizes = [r["count"] for r in each]
    assert sum(sizes) == 60 * 59 * 58 and len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16
    assert got.distinct().count() == 60 * 59 * 58
    assert got.where("i1 = i2 or i1 = i3 or i2 = i3 or i3 is null").count() == 0


@pytest.mark.parametrize("selections", [1, 2, 7])
def test_ranges_of_any_length(spark, selections):
    df = spark.createDataFrame(DATA, "key string, item string, attr string")
    got = ordered_selections(df, "key", "item", NAMES, attrs=["attr"], selections=selections)
    assert rows(got) == brute(DATA, 4)
