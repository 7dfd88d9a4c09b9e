import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.sources import feeds, landing as L
from tests.conftest import rows

ODD = [
    'a,b,c',
    '"a,1",b,c',
    '"say ""hi""",b,c',
    '"back\\"slash,b,c',
    '\\N,"\\N",',
    ',,',
    '""," ",x',
    'a,b',
    'a,b,c,d',
    '',
    'a"b,c"d,e',
    '"a"b"c,d,e',
    '"",,""',
    'é,"日本, x",y',
    '"open,b,c',
    ' "x",y,z',
]


def parsed(lines):
    return [next(csv.reader([line]), []) for line in lines]


def test_csv_fields_match_the_standard_reader(spark):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(ODD)], "i int, value string")
    got = [r.f for r in df.orderBy("i").select(L.csv_fields("value").alias("f")).collect()]
    assert got == parsed(ODD)


def test_csv_fields_on_random_lines(spark):
    rng = random.Random(7)
    lines = ["".join(rng.choice('ab,"\\ ') for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    got = [r.f for r in df.orderBy("i").select(L.csv_fields("value").alias("f")).collect()]
    assert got == parsed(lines)


def test_long_quoted_field(spark):
    line = '"' + "x," * 50_000 + 'y",b,c'
    df = spark.createDataFrame([(line,)], "value string")
    assert L.csv_rows(df, ["a", "b", "c"]).select(F.length("a"), "c").head() == (100_001, "c")


def test_csv_file_rows_and_metrics(spark, tmp_path):
    path = tmp_path / "planes.dat"
    path.write_text('"Airbus A320","320","A320"\r\n"x, y",\\N,\\N\r\n\r\nshort,1\r\nl,o,n,g\r\n', newline="")
    assert rows(feeds.aviation_table(spark, "planes", str(path))) == rows(
        spark.createDataFrame([("Airbus A320", "320", "A320"), ("x, y", "\\N", "\\N")], "Name string, IATA string, ICAO string")
    )
    assert feeds.aviation_metrics(spark, "planes", str(path)).head() == (5, 3, "Name, IATA, ICAO")


def land(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, indent=2))


def test_tagged_payloads(spark, tmp_path):
    land(tmp_path / "source_glass=Mug" / "a.json", {"drinks": [{"idDrink": "1", "strDrink": "Tea"}, "junk", 5]})
    land(tmp_path / "source_glass=Jar" / "a.json", {"drinks": "None Found"})
    land(tmp_path / "source_glass=Cup" / "a.json", {"drinks": None})
    land(tmp_path / "source_glass=Pot" / "a.json", {"drinks": [{"idDrink": "1"}, {"idDrink": "2", "x": {"y": 1}}]})
    got = feeds.drinks_by_tag(spark, str(tmp_path)).select("source_glass", "idDrink", "strDrink")
    assert rows(got) == [("Mug", "1", "Tea"), ("Pot", "1", None), ("Pot", "2", None)]


def test_draws_are_a_bag(spark, tmp_path):
    for n in range(3):
        land(tmp_path / f"draw{n}.json", {"drinks": [{"idDrink": "7"}]})
    assert feeds.drink_draws(spark, str(tmp_path)).where("idDrink = '7'").count() == 3


def test_meal_names_are_snake_case(spark, tmp_path):
    land(tmp_path / "a.json", {"meals": [{"idMeal": "1", "strMeal": "Pie", "strIngredient12": "salt"}]})
    got = feeds.meal_draws(spark, str(tmp_path)).head()
    assert (got.id_meal, got.str_meal, got.str_ingredient12) == ("1", "Pie", "salt")


def test_value_list(spark, tmp_path):
    land(tmp_path / "a.json", {"drinks": [{"strGlass": "Mug"}, {"other": 1}, {"strGlass": "Jar"}]})
    got = L.value_list(L.read_payloads(spark, str(tmp_path), "drinks"), "strGlass")
    assert rows(got) == [("Jar",), ("Mug",)]


def test_show_tables(spark, tmp_path):
    for page, ids in enumerate([(1, 2), (3,)]):
        people = [
            {
                "id": i,
                "name": f"n{i}",
                "origin": {"name": "Earth", "url": ""},
                "location": {"name": "Mars", "url": "u"},
                "episode": [f"https://x/{i}", "https://x/9"] if i < 3 else [],
                "created": "2017-11-04T18:48:46.250Z",
            }
            for i in ids
        ]
        land(tmp_path / f"page{page}.json", {"info": {"count": 3}, "results": people})
    parents, children = feeds.show_tables(spark, str(tmp_path), feeds.CHARACTER, "episode")
    assert {"origin__name", "location__url", "_dlt_id"} <= set(parents.columns)
    assert parents.count() == 3 and children.count() == 4
    joined = children.join(parents, children._dlt_root_id == parents._dlt_id)
    assert rows(joined.select("id", "_dlt_list_idx", "value")) == [
        (1, 0, "https://x/1"),
        (1, 1, "https://x/9"),
        (2, 0, "https://x/2"),
        (2, 1, "https://x/9"),
    ]


def test_books_and_subjects(spark, tmp_path):
    docs = [
        {"key": "/works/OL1W", "title": "A", "author_name": ["x", "y"], "has_fulltext": True},
        {"key": "/books/OL2M", "title": "B", "language": ["eng"]},
        {"title": "C"},
    ]
    land(tmp_path / "books" / "search_term=DuckDB" / "1.json", {"numFound": 3, "docs": docs})
    books = feeds.read_books(spark, str(tmp_path / "books"))
    got = {r.title: r for r in books.collect()}
    assert [a.name for a in got["A"].authors] == ["x", "y"] and got["A"].languages == []
    assert got["B"].has_fulltext is False and [c.code for c in got["B"].languages] == ["eng"]
    assert rows(feeds.work_ids(books)) == [("OL1W",)]
    authors = L.child_table(L.with_row_id(books, ["key"]), "authors")
    assert sorted(authors.columns) == ["_dlt_list_idx", "_dlt_root_id", "name"]
    works = spark.createDataFrame(
        [("w", ["a", "", None, "b"]), ("v", []), ("u", None)], "work_id string, subjects array<string>"
    )
    assert rows(feeds.subjects(works)) == [("w", "a"), ("w", "b")]
    assert rows(feeds.loaded_keys(books, ["DuckDB"]).select("key")) == [("/books/OL2M",), ("/works/OL1W",), (None,)]


def test_city_details(spark):
    cities = spark.createDataFrame(
        [(1, "A", 1.0, 2.0, "Australia", "AU"), (2, "B", 1.0, 2.0, "Oz", "AU"), (3, "C", 0.0, 0.0, "NZ", "NZ")],
        "geonameId bigint, name string, lat double, lng double, countryName string, country_code string",
    )
    details = spark.createDataFrame([(1, "", "r", "1", "OC"), (2, "Full", None, None, "OC")], feeds.CITY_DETAIL)
    got = feeds.cities_with_details(cities, details).select("city_id", "country", "region")
    assert rows(got) == [(1, "Australia", "r"), (2, "Full", None), (3, "NZ", None)]


def test_daily_weather(spark):
    payload = {
        "city": "Perth",
        "lat": -31.9,
        "lng": 115.8,
        "daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [30.0, None]},
    }
    df = spark.read.schema(feeds.WEATHER).json(spark.sparkContext.parallelize([json.dumps(payload)]))
    got = feeds.daily_weather(df, F.lit("t"))
    assert rows(got.select(F.col("date").cast("string"), "temperature_max", "uv_index_max", "location__lat")) == [
        ("2024-01-01", 30.0, None, -31.9),
        ("2024-01-02", None, None, -31.9),
    ]


def test_activities(spark):
    items = [
        {"id": "1", "snippet": {"type": "upload", "publishedAt": "2024-01-02T00:00:00Z"}, "contentDetails": {"upload": {"videoId": "v"}}},
        {"id": "2", "snippet": {"type": "addToPlaylist", "publishedAt": "2024-01-03T00:00:00Z"}, "contentDetails": {"addToPlaylist": {"playlistId": "p"}, "upload": {"videoId": "v"}}},
        {"id": "3", "snippet": {"type": "like", "publishedAt": "2024-01-01T00:00:00Z"}, "contentDetails": {}},
    ]
    df = spark.read.schema(feeds.ACTIVITY_ITEM).json(spark.sparkContext.parallelize([json.dumps(i) for i in items]))
    df = df.withColumn("channel_id", F.lit("c"))
    got = feeds.activities(df, "2024-01-01T00:00:00Z").select("id", "video_id", "playlist_id")
    assert rows(got) == [("1", "v", None), ("2", None, "p")]
    assert feeds.activities(df).count() == 3


def test_sheet_times(spark):
    df = spark.createDataFrame([("2025-05-01 10:00:00",), ("nonsense",), (None,)], "DateTime string")
    got = [r[0] for r in feeds.stock_ticks(df).select(F.col("DateTime").cast("string")).collect()]
    assert got == ["2025-05-01 10:00:00", None, None]


def test_parallel_lists_of_unequal_length(spark):
    df = spark.createDataFrame([(1, [1, 2], ["a"])], "i int, n array<int>, s array<string>")
    assert rows(L.zip_lists(df, {"n": "n", "s": "s"}, "i")) == [(1, 1, "a"), (1, 2, None)]


def test_load_counts_while_it_writes(spark, tmp_path):
    lines = spark.createDataFrame([("1,2",), ("3",), ('"a,b",c',), ("x,y,z",), ("",)], "value string")
    found = L.load_csv(lines, ["a", "b"], str(tmp_path / "t"))
    assert found == {"row_count": 5, "malformed_rows": 3, "headers": "a, b"}
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == [("1", "2"), ("a,b", "c")]
    assert tuple(L.csv_metrics(lines, ["a", "b"]).head()) == (5, 3, "a, b")
