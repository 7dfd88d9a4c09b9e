from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.functions import fixed_values as V


def one(spark, value, column, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column(F.col("x"))).head()[0]


@pytest.mark.parametrize(
    "value, expected",
    [("", None), (None, None), ("  ", None), (" a\\n ", "a"), ("\\n", None), ("\\N", "\\N"), ("a\nb", "a\nb")],
)
def test_clean_text(spark, value, expected):
    assert one(spark, value, C.clean_text) == expected


@pytest.mark.parametrize("value, expected", [("\\N", None), ("\\n", "\\n"), ("N", "N"), ("", ""), (None, None)])
def test_null_marker(spark, value, expected):
    assert one(spark, value, C.null_marker) == expected


def test_surrogate_key(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, 3)], "a string, b string, c int")
    got = df.select(C.surrogate_key("a", "b", "c")).head()[0]
    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-3").hexdigest()


def test_first_filled(spark):
    df = spark.createDataFrame([("", "x"), (None, "y"), ("z", "w"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(C.first_filled("a", "b")).collect()] == ["x", "y", "z", ""]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("AIRBUS A320", "Airbus"),
        ("BAe 146", "British Aerospace (BAe)"),
        ("Gulfstream/Rockwell 690", "Gulfstream"),
        ("bell 206", "Bell"),
        ("British Aerospace 31", "British Aerospace"),
        ("Concorde", "Other"),
        ("New Airbus", "Other"),
        ("", "Other"),
        (None, "Other"),
    ],
)
def test_aircraft_maker(spark, name, expected):
    assert one(spark, name, C.aircraft_maker) == expected


def test_prefix_rules_keep_their_order(spark):
    rules = [("ab", "short"), ("abc", "long"), ("x.y", "dot")]
    assert one(spark, "ABCD", lambda c: C.prefix_label(c, rules, "no")) == "short"
    assert one(spark, "x-y", lambda c: C.prefix_label(c, rules, "no")) == "no"
    assert one(spark, "X.Y!", lambda c: C.prefix_label(c, rules, "no")) == "dot"


@pytest.mark.parametrize(
    "name, expected",
    [
        ("rick sanchez", "Rick"),
        ("Rickety", "Other"),
        ("MORTY", "Morty"),
        ("Evil Rick", "Other"),
        ("Beth's clone", "Beth"),
        (None, "Other"),
    ],
)
def test_character_group(spark, name, expected):
    assert one(spark, name, C.character_group) == expected


@pytest.mark.parametrize(
    "name, expected",
    [
        ("The Ricklantis Mixup", "Rick-Focused"),
        ("Rick & Mortys", "Morty-Focused"),
        ("Rixty Minutes", "Interdimensional Cable"),
        ("Total Rickall", "Other"),
        ("Look Who's Purging: Jack", "Pop Culture Reference"),
        (None, "Other"),
    ],
)
def test_episode_group(spark, name, expected):
    assert one(spark, name, C.episode_group) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Dimension C-137", "Standard Format"),
        ("unknown dimension c", "Unclassified"),
        ("The FASCIST one", "Fascist Variant"),
        ("Pizza", "Thematic"),
        ("Cronenberg Dimension", "Canonical Named"),
        ("Somewhere", "Other"),
        (None, "Other"),
    ],
)
def test_dimension_group(spark, value, expected):
    assert one(spark, value, C.dimension_group) == expected


def test_location_category(spark):
    assert one(spark, "Dwarf planet (Celestial Dwarf)", C.location_category) == "Celestial Body"
    assert one(spark, "Woods", C.location_category) == "Unknown"
    assert one(spark, None, C.location_category) == "Unknown"


def test_ids_and_codes(spark):
    assert one(spark, "https://x/api/episode/28", C.trailing_id) == 28
    assert one(spark, "/works/OL1W", C.last_segment) == "OL1W"
    assert one(spark, "S01E07", lambda c: C.code_number(c, 5, 2)) == 7


def test_id_without_number_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "https://x/none", C.trailing_id)


@pytest.mark.parametrize(
    "text", ["a b\tc", "Crème brûlée", "x/y:z", "k v", "tab\x1cfs", "ok_1-2.3", "", "日本 x"]
)
def test_safe_name(spark, text):
    import re

    ascii_only = "".join(text.split()).encode("ascii", errors="ignore").decode()
    assert one(spark, text, C.safe_name) == re.sub(r"[^\w\-.]", "_", ascii_only, flags=re.ASCII)


def test_long_date(spark):
    assert one(spark, "December 2, 2013", C.long_date) == datetime(2013, 12, 2)
    assert one(spark, "September 05, 2021", C.long_date) == datetime(2021, 9, 5)


def test_zone_directions(spark):
    df = spark.sql("select timestamp_ntz'2025-01-01 00:00:00' n, timestamp'2025-01-01 00:00:00' z")
    forward, backward = df.select(
        C.to_local("n").cast("string"), C.reinterpret_utc_as("z").cast("string")
    ).head()
    assert forward == "2025-01-01 11:00:00"
    assert backward == "2024-12-31 13:00:00"


def test_utc_date_of_local_text(spark):
    assert one(spark, "2025-01-01 05:00:00", C.utc_date_of_local_text) == date(2024, 12, 31)
    assert one(spark, "2025-07-01 11:00:00", C.utc_date_of_local_text) == date(2025, 7, 1)
    assert one(spark, None, C.utc_date_of_local_text) is None


def test_local_noon(spark):
    # summer time and standard time
    assert one(spark, "2025-01-10", lambda c: C.utc_text_of_local_noon(c.cast("date"))) == "2025-01-10T01:00:00Z"
    assert one(spark, "2025-07-10", lambda c: C.utc_text_of_local_noon(c.cast("date"))) == "2025-07-10T02:00:00Z"


@pytest.mark.parametrize(
    "utc, open_",
    [
        ("2025-05-01 00:00:00", True),  # Thursday 10:00:00 in Sydney
        ("2025-04-30 23:59:59", False),
        ("2025-05-01 06:00:00", True),  # 16:00:00 is still open
        ("2025-05-01 06:00:00.000001", False),
        ("2025-05-03 01:00:00", False),  # Saturday
        ("2025-05-04 23:00:00", False),  # Monday 09:00
    ],
)
def test_market_hours(spark, utc, open_):
    assert one(spark, utc, lambda c: C.in_market_hours(c.cast("timestamp_ntz"))) is open_


def test_fixed_values_are_consistent():
    assert len(V.MAKER_PREFIXES) == 34
    assert len(V.WEATHER_PLACES) == 15
    assert [len(V.AVIATION_HEADERS[k]) for k in ("airlines", "airports", "routes", "planes")] == [8, 14, 9, 3]
