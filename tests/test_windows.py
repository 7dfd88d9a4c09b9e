import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import windows as W
from tests.conftest import plan_text, rows


def measures(frame, ordered):
    return {
        "mean": F.avg("v").over(frame),
        "n": F.count(F.lit(1)).over(frame),
        "step": F.col("v") - F.lag("v").over(ordered),
    }


def brute(data, size):
    """Per key, in (day, seq) order with missing days last, over the last ``size`` rows."""
    groups = defaultdict(list)
    for key, day, seq, v in data:
        groups[key].append((day is None, day or date.min, seq, v))
    out = []
    for key, items in groups.items():
        items.sort(key=lambda r: r[:3])
        for i, (_, _, seq, v) in enumerate(items):
            window = [r[3] for r in items[max(0, i - size + 1) : i + 1]]
            known = [x for x in window if x is not None]
            mean = sum(known) / len(known) if known else None
            before = items[i - 1][3] if i else None
            step = v - before if v is not None and before is not None else None
            out.append((key, seq, mean, len(window), step))
    return sorted(out, key=repr)


def series(seed):
    rng = random.Random(seed)
    data, seq = [], 0
    for key, n in (("hot", 900), ("cold", 20), (None, 40), ("one", 1)):
        for _ in range(n):
            day = date(2020, 1, 1) + timedelta(days=rng.choice([rng.randint(0, 60), rng.randint(0, 2000)]))
            seq += 1
            data.append((key, None if rng.random() < 0.05 else day, seq, None if rng.random() < 0.1 else float(rng.randint(0, 99))))
    return data


SCHEMA = "key string, day date, seq bigint, v double"


@pytest.mark.parametrize("slice_rows", [14, 50, 10_000])
@pytest.mark.parametrize("size", [2, 14])
def test_trailing_equals_brute_force(spark, slice_rows, size):
    data = series(size)
    df = spark.createDataFrame(data, SCHEMA)
    got = W.trailing(df, ["key"], ["day", "seq"], measures, size, slice_rows)
    assert set(got.columns) == {*df.columns, "mean", "n", "step"}
    want = brute(data, size)
    have = rows(got.select("key", "seq", "mean", "n", "step"))
    assert [r[:2] + r[3:] for r in have] == [r[:2] + r[3:] for r in want]
    assert [r[2] for r in have] == pytest.approx([r[2] for r in want])


def test_ties_give_the_same_rows_however_they_are_cut(spark):
    data = [("k", date(2020, 1, 1 + i // 9), i, float(i * 7 % 31)) for i in range(200)]
    df = spark.createDataFrame(data, SCHEMA)
    results = [
        rows(W.trailing(part, ["key"], ["day"], measures, 14, n))
        for part, n in ((df, 20), (df.repartition(7), 20), (df.orderBy(F.desc("seq")), 64), (df, 100_000))
    ]
    assert all(r == results[0] for r in results)


def test_trailing_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert W.trailing(df, ["key"], ["day", "seq"], measures, 14).count() == 0
    with pytest.raises(ValueError, match="longer"):
        W.trailing(df, ["key"], ["day", "seq"], measures, 14, 13)


def test_no_task_holds_a_whole_key(spark):
    df = spark.createDataFrame(series(1), SCHEMA)
    text = plan_text(W.trailing(df, ["key"], ["day", "seq"], measures, 14, 50))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and all("__slice" in w.split("], [")[1] for w in windows)
    assert "hashpartitioning(__slice" in text and "hashpartitioning(key" not in text


def test_price_movement(spark):
    t = datetime(2025, 5, 1, 10)
    data = [
        (1, "A", 10.0, t),
        (2, "A", 12.5, t + timedelta(hours=1)),
        (3, "A", 11.0, t + timedelta(hours=1)),  # same time, higher id: the last one
        (4, "A", 1.005, None),  # no time: after all others
        (5, "B", 7.0, t),
        (None, None, 3.0, t),
        (7, None, 5.0, t - timedelta(days=1)),
    ]
    df = spark.createDataFrame(data, "id bigint, stock string, price double, datetime timestamp_ntz")
    got = W.price_movement(df).select(
        "id", *[F.col(c).cast("double") for c in ("price_spread", "relative_price_movement", "abs_price_movement")], "num_stock_entries"
    )
    assert rows(got) == sorted(
        [
            (1, 11.5, 0.0, -9.0, 4),
            (2, 11.5, 2.5, -9.0, 4),
            (3, 11.5, 1.0, -9.0, 4),
            (4, 11.5, -9.0, -9.0, 4),
            (5, 0.0, 0.0, 0.0, 1),
            (None, 2.0, -2.0, -2.0, 1),
            (7, 2.0, 0.0, -2.0, 1),
        ],
        key=repr,
    )


def test_price_movement_does_not_gather_ticks_by_stock(spark):
    df = spark.range(1000).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("stock"), F.rand(1).alias("price"), F.current_timestamp().alias("datetime")
    )
    text = plan_text(W.price_movement(df))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "Window" not in text
