from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import dims, planning as P
from tests.conftest import plan_text, rows


def gate_tables(spark, cases):
    """cases: key -> (incoming, stored or None, previous or None)"""
    incoming = spark.createDataFrame([(k, c[0]) for k, c in cases.items()], "k string, incoming bigint")
    stored = spark.createDataFrame([(k, c[1]) for k, c in cases.items() if c[1] is not None], "k string, stored bigint")
    state = spark.createDataFrame([(k, c[2]) for k, c in cases.items() if c[2] is not None], "k string, previous bigint")
    return incoming, stored, state


CASES = {
    "first": (5, None, None),
    "same": (5, 5, 5),
    "grown": (7, 5, 5),
    "shrunk": (3, 5, 5),
    "lost rows": (5, 4, 5),
    "emptied": (5, None, 5),
    "empty feed": (0, None, None),
    "more stored": (5, 9, 5),
}


def decided(df):
    return {r.k: (r.action, r.next_previous) for r in df.collect()}


def test_reload_gate(spark):
    got = decided(P.reload_gate(*gate_tables(spark, CASES), "k"))
    assert got == {
        "first": ("reload", 5),
        "same": ("skip", 5),
        "grown": ("load", 7),
        "shrunk": ("load", 3),
        "lost rows": ("reload", 5),
        "emptied": ("reload", 5),
        "empty feed": ("reload", 0),
        "more stored": ("skip", 5),
    }


def test_count_gate(spark):
    got = decided(P.count_gate(*gate_tables(spark, CASES), "k"))
    assert got["first"] == ("load", 5)
    assert got["lost rows"] == got["emptied"] == ("reload", 5)
    assert got["same"] == got["more stored"] == ("skip", 5)
    assert got["empty feed"] == ("skip", 0)
    loose = decided(P.count_gate(*gate_tables(spark, CASES), "k", heed_table=False))
    assert loose["lost rows"] == loose["emptied"] == ("skip", 5)


def test_growth_gate(spark):
    df = P.growth_gate(*gate_tables(spark, {**CASES, "pages": (201, 1, 100)}), "k")
    got = decided(df)
    assert got["same"] == got["lost rows"] == got["more stored"] == ("skip", 5)
    assert got["grown"] == ("load", 7) and got["shrunk"] == ("load", 3)
    assert got["emptied"] == ("load", 5) and got["first"] == ("load", 5)
    assert {r.k: r.pages for r in df.collect()}["pages"] == 3


def test_state_goes_on(spark):
    state = spark.createDataFrame([("kept", 1), ("same", 5)], "k string, previous bigint")
    tables = gate_tables(spark, {"same": (5, 5, 5), "new": (9, None, None)})
    got = P.advance_state(state, P.reload_gate(*tables, "k"), "k")
    assert rows(got) == [("kept", 1), ("new", 9), ("same", 5)]


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(P.count_per_key(df, "k")) == [("a", 2), (None, 1)]
    assert rows(P.counts_per_table({"x": df, "none": df.limit(0)})) == [("none", 0), ("x", 3)]


def test_next_ranges(spark):
    wanted = spark.createDataFrame([(k,) for k in "abcdef"], "k string")
    mark = spark.createDataFrame(
        [
            ("a", date(2021, 1, 1), date(2021, 1, 10)),  # complete
            ("b", date(2021, 1, 1), date(2021, 1, 5)),  # goes on
            ("c", date(2021, 1, 5), date(2021, 1, 10)),  # started late, nothing after its end
            ("d", date(2019, 1, 1), date(2020, 6, 1)),  # ended before the base
            ("e", date(2020, 1, 1), date(2021, 1, 9)),  # long enough but not to the end
        ],
        "k string, min_date date, max_date date",
    )
    got = {r.k: (str(r.start_date), r.status) for r in P.next_ranges(wanted, mark, "k", "2021-01-01", "2021-01-10").collect()}
    assert got == {
        "a": ("2021-01-11", "skipped"),
        "b": ("2021-01-06", "fetch"),
        "c": ("2021-01-11", "skipped"),
        "d": ("2021-01-01", "fetch"),
        "e": ("2021-01-10", "fetch"),
        "f": ("2021-01-01", "fetch"),
    }


@pytest.mark.parametrize(
    "start, end, want",
    [
        ("2021-03-01", "2021-04-01", [("2021-03-01", "2021-04-01")]),
        ("2021-12-31", "2023-01-01", [("2021-12-31", "2021-12-31"), ("2022-01-01", "2022-12-31"), ("2023-01-01", "2023-01-01")]),
        ("2021-01-02", "2021-01-01", []),
        ("2023-01-02", "2021-01-01", []),
        ("2024-02-29", "2024-02-29", [("2024-02-29", "2024-02-29")]),
    ],
)
def test_year_chunks(spark, start, end, want):
    df = spark.sql(f"select 'k' k, date'{start}' start_date, date'{end}' end_date")
    got = P.year_chunks(df).select(F.col("chunk_start").cast("string"), F.col("chunk_end").cast("string"))
    assert rows(got) == want


def test_missing_dates_and_work_list(spark):
    days = dims.calendar(spark, "2024-01-01", "2024-01-31")
    loaded = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-20')) d").where("day(d) not in (3, 5, 9)")
    got = P.missing_dates(days, loaded, "date_col", "d", "2024-01-22", newest=3)
    assert [str(r[0]) for r in got.collect()] == ["2024-01-21", "2024-01-09", "2024-01-05"]
    assert "TakeOrderedAndProject" in plan_text(got)
    places = spark.createDataFrame([("Sydney",), ("Perth",)], "city string")
    listed = P.work_list(got, "date_col", places)
    assert listed.count() == 6 and {r.dt for r in listed.collect()} == {
        "2024-01-05T01:00:00Z",
        "2024-01-09T01:00:00Z",
        "2024-01-21T01:00:00Z",
    }
    text = plan_text(listed)
    assert "Cartesian" not in text and "NestedLoop" not in text
    nothing = P.missing_dates(days, loaded, "date_col", "d", "2024-01-02")
    assert P.work_list(nothing, "date_col", places).count() == 0


def test_cursor(spark):
    df = spark.createDataFrame([(1, "2024-01-03"), (2, "2024-01-02"), (3, "2024-01-01")], "id int, p string")
    assert rows(P.after_cursor(df, "p", "2024-01-02").select("id")) == [(1,)]
    assert rows(P.after_cursor(df, "p", "2024-01-02", inclusive=True).select("id")) == [(1,), (2,)]
    assert P.after_cursor(df, "p", None).count() == 3
    # newest first: the cursor is the highest time, not the last one read
    assert P.next_cursor(df, "p", "2024-01-01").head()[0] == "2024-01-03"
    assert P.next_cursor(df.limit(0), "p", "2024-01-01").head()[0] == "2024-01-01"
    assert P.next_cursor(df, "p", None).head()[0] == "2024-01-03"


@pytest.mark.parametrize(
    "statuses, want",
    [
        (["success", "failed"], (True, False, False, 1)),
        (["skipped", "skipped_no_new_data"], (False, True, False, 0)),
        (["failed", "failed"], (False, False, True, 0)),
        (["failed", None], (False, False, False, 0)),
        (["success", "success", ""], (True, False, False, 2)),
    ],
)
def test_status_rollup(spark, statuses, want):
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert tuple(P.status_rollup(df).head()) == want


def test_freshness(spark):
    df = spark.sql("select 'new' k, timestamp_ntz'2025-05-09 00:00:00' t union all select 'old', timestamp_ntz'2025-05-02 23:00:00' union all select 'gone', timestamp_ntz'2025-01-01 00:00:00'")
    as_of = F.lit("2025-05-10 00:00:00").cast("timestamp_ntz")
    got = P.freshness(df, "t", as_of, 7, 14, by=["k"])
    assert rows(got.select("k", "status")) == [("gone", "error"), ("new", "pass"), ("old", "warn")]
    assert P.freshness(df.limit(0), "t", as_of, 7, 14).head().status == "error"


def test_loaded_range(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 9)], "k string, d int")
    keys = spark.createDataFrame([("a",), ("a",)], "k string")
    assert tuple(P.loaded_range(df, "d", keys, "k").head()) == (1, 5)
    assert tuple(P.loaded_range(df, "d").head()) == (1, 9)


def test_calendar(spark):
    df = dims.calendar(spark)
    assert df.count() == 10958
    got = {str(r.date_col): r for r in df.where("date_col in ('2000-01-01', '2024-02-29', '2029-12-31')").collect()}
    first = got["2000-01-01"]
    assert (first.weekday_name, first.day_of_week, first.is_weekend, first.week_of_year) == ("Saturday", 6, True, 52)
    leap = got["2024-02-29"]
    assert (leap.month_name, leap.day_of_year, leap.quarter, leap.is_weekend) == ("February", 60, 1, False)
    assert (got["2029-12-31"].weekday_name, got["2029-12-31"].day_of_week) == ("Monday", 1)
    assert dict(df.dtypes)["year"] == "bigint"


def test_weather_end(spark):
    got = spark.sql("select timestamp_ntz'2025-05-10 13:30:00' n, timestamp_ntz'2025-05-10 14:30:00' m")
    assert tuple(map(str, got.select(P.weather_end("n"), P.weather_end("m")).head())) == ("2025-05-08", "2025-05-09")


def test_holes_come_back_as_ranges(spark):
    """Random loaded days and wanted ranges against counting day by day."""
    import datetime as dt
    import random

    rng, base = random.Random(3), dt.date(2024, 2, 20)
    day = lambda n: base + dt.timedelta(n)
    loaded = [(k, day(rng.randrange(60))) for k in "abcd" for _ in range(45)] * 2 + [(None, day(1)), ("a", None)]
    wanted = [("a", day(5), day(50)), ("a", day(0), day(3)), ("b", day(-9), day(70)), ("c", day(10), day(9)), ("e", day(0), day(1)), (None, day(0), day(2))]
    spans = P.loaded_spans(spark.createDataFrame(loaded, "k string, day date"), "k", "day")
    have = {(k, d) for k, d in loaded if d}
    covered = [(r.k, r.span_start + dt.timedelta(i)) for r in spans.collect() for i in range((r.span_end - r.span_start).days + 1)]
    assert len(covered) == len(set(covered)) and set(covered) == have
    assert all((r.k, r.span_end + dt.timedelta(1)) not in have for r in spans.collect())
    found = P.missing_spans(spark.createDataFrame(wanted, "k string, start_date date, end_date date"), spans, "k")
    expected = []
    for k, first, last in wanted:
        days = [first + dt.timedelta(i) for i in range((last - first).days + 1)]
        gone = [d for d in days if k is None or (k, d) not in have]
        for d in gone:
            if expected and expected[-1][0] == k and expected[-1][2] == d - dt.timedelta(1) and d > first:
                expected[-1] = (k, expected[-1][1], d)
            else:
                expected.append((k, d, d))
    assert rows(found) == sorted(expected, key=repr)
