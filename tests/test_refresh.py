"""Frames replaced by late rows against a full run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import refresh
from lakeloom.operators.versioned import version_of
from lakeloom.operators.windows import trailing
from tests.conftest import rows

SCHEMA = "city string, day date, temp double"


def month():
    return F.year("day") * 12 + F.month("day")


def measures(frame, ordered):
    temp = F.col("temp")
    return {"avg": F.round(F.avg(temp).over(frame), 6), "n": F.count(temp).over(frame), "change": F.round(temp - F.lag(temp).over(ordered), 6)}


def whole(spark, data):
    return rows(trailing(spark.createDataFrame([(c, d, t) for (c, d), t in data.items()], SCHEMA), ["city"], ["day"], measures, 14))


@pytest.mark.parametrize("seed, density", [(1, 0.9), (2, 0.12)])
def test_equal_to_a_full_run(spark, tmp_path, seed, density):
    """Dense days, and days so sparse that a frame reaches over many months."""
    rng, path, first = random.Random(seed), str(tmp_path), dt.date(2023, 1, 1)
    days = [first + dt.timedelta(i) for i in range(420)]
    data = {(c, d): round(rng.uniform(-5, 30), 1) for c in ("Perth", "Hobart", None) for d in days if rng.random() < density}
    late = dict(rng.sample(sorted(data.items(), key=repr), 6))
    so_far = {k: v for k, v in data.items() if k not in late}

    def load(some):
        frame = spark.createDataFrame([(c, d, t) for (c, d), t in some.items()], SCHEMA)
        return refresh.refresh_trailing(frame, path, ["city"], ["day"], measures, 14, month(), slice_rows=50)

    load(so_far)
    assert rows(refresh.read_trailing(spark, path)) == whole(spark, so_far)
    changes = {k: 99.0 for k in rng.sample(sorted(so_far, key=repr), 2)}
    new_city = {("Darwin", first): 1.0, (None, dt.date(2030, 1, 1)): 2.0}
    for some in ({**late, **changes}, new_city, late):
        so_far.update(some)
        found = load(some)
        assert found.count() <= 14 * len(some)
        assert rows(refresh.read_trailing(spark, path)) == whole(spark, so_far)


def test_reads_and_writes_what_changed(spark, tmp_path):
    path, first = str(tmp_path), dt.date(2020, 1, 1)
    data = [(c, first + dt.timedelta(i), float(i % 17)) for c in ("a", "b") for i in range(1200)]
    refresh.refresh_trailing(spark.createDataFrame(data, SCHEMA), path, ["city"], ["day"], measures, 14, month())
    before = version_of(spark, f"{path}/table")
    late = spark.createDataFrame([("a", dt.date(2021, 5, 10), 50.0)], SCHEMA)
    needed = refresh._needed(
        refresh._counts(spark, path, 1), late.select("city", month().cast("int").alias("__slot")), ["city"], 13
    )
    assert {(r.city, r["__slot"]) for r in needed.collect()} == {("a", 2021 * 12 + m) for m in (4, 5, 6)}
    found = refresh.refresh_trailing(late, path, ["city"], ["day"], measures, 14, month())
    assert found.count() == 14
    after = version_of(spark, f"{path}/table")
    assert {s for s in after.loads if after.loads[s] != before.loads[s]} == {2021 * 12 + 5}
