"""Whole subjects, built over the feeds derived from the smallest tables."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.merge import latest_per_key
from lakeloom.operators.quality import Related
from lakeloom.plans import build as B
from lakeloom.plans import contracts
from lakeloom.sinks.publish import ChecksFailed, EmptyInput, current_version, published
from lakeloom.sources import feeds as S
from lakeloom.workload import inputs as I
from lakeloom.workload.registry import Tables
from tests.conftest import SF


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


def failures(build):
    return {(r.table_name, r["check"], r["column"]): r.failures for r in build.report().collect() if r.status == "fail"}


def test_drinks(t, tmp_path):
    feeds = {n: getattr(I, n)(t) for n in ("beverages_table", "alcoholic_table", "ingredients_table", "beverage_fact_data")}
    for run_at, glasses in I.glass_tables(t):
        b = B.build_drinks({**feeds, "glass_table": glasses}, str(tmp_path), run_at[:10], run_at)
    assert b.tables["fact_beverage_consumption"].count() == t.lineitem.count()
    assert b.tables["glass_type_snapshot"].where("dbt_valid_to is not null").count() > 0
    assert b.tables["dim_beverage_ingredient_hierarchy"].count() > b.tables["base_beverage_ingredients_lookup"].count()
    assert failures(b) == {}
    assert published(t.spark, "common", "dim_beverage_type").count() == b.tables["dim_beverage_type"].count()


def test_empty_fact_stops_the_build(t, tmp_path):
    with pytest.raises(EmptyInput):
        B.build_drinks({"beverage_fact_data": I.beverage_fact_data(t).limit(0)}, str(tmp_path), "1", "2025-05-01 00:00:00")


def test_meals(t, tmp_path):
    names = ("country_table", "category_table", "ingredient_table", "ingredients", "consumption")
    b = B.build_meals({n: getattr(I, n)(t) for n in names}, str(tmp_path), "1")
    assert b.tables["fact_meal_consumption"].count() == t.orders.count()
    # meals share their country and category, so the category dimension is checked and found unique
    assert failures(b) == {}


def test_weather(t, tmp_path):
    feeds = {n: getattr(I, n)(t) for n in ("geo_cities", "daily_weather", "uv_index")}
    with pytest.raises(ChecksFailed, match="base_uv"):  # a reading that landed twice
        given = {n: [Related("city", "base_geo", "city")] for n in ("base_weather", "base_uv")}
        B.build_weather(feeds, str(tmp_path / "stopped"), "1", "2001-07-20", given)
    assert current_version(t.spark, str(tmp_path / "stopped"), "base", "base_uv") is None
    feeds["uv_index"] = latest_per_key(feeds["uv_index"], ["uv_time", "city"], ["uv"])
    with pytest.raises(ChecksFailed, match="base_weather.*relationships of city"):  # places outside the country filter
        B.build_weather(feeds, str(tmp_path / "stopped"), "2", "2001-07-20")
    outside = Related("city", "base_geo", "city")
    b = B.build_weather(feeds, str(tmp_path), "1", "2001-07-20", {"base_weather": [outside], "base_uv": [outside]})
    assert b.tables["fact_weather"].count() == b.tables["base_weather"].count()
    assert b.tables["staging_uv_data_dates"].count() == 6
    bad = failures(b)
    assert ("base_weather", "relationships", "city") in bad  # places outside the country filter
    assert ("base_weather", "unique_combination", "weather_date,city") not in bad


def test_stocks_twice(t, tmp_path):
    ticks = I.stock_ticks(t)
    early = ticks.where(F.col("datetime") < F.lit("2024-01-20").cast("timestamp"))
    assert B.build_stocks({"gsheet_finance_data": early}, str(tmp_path), "1").tables["base_gsheets_finance"].count() == early.count()
    for _ in range(2):
        b = B.build_stocks({"gsheet_finance_data": ticks}, str(tmp_path), "2")
        assert b.tables["base_gsheets_finance"].count() == ticks.count()
    assert failures(b) == {}


def test_old_and_broken_feeds_stop_the_build(t, tmp_path):
    ticks = I.stock_ticks(t)
    with pytest.raises(B.FeedTooOld, match="gsheet_finance_data"):
        B.build_stocks({"gsheet_finance_data": ticks}, str(tmp_path), "1", fresh_at="2024-12-01 00:00:00")
    with pytest.raises(ChecksFailed, match="gsheet_finance_data: unique of id"):
        B.build_stocks({"gsheet_finance_data": ticks.union(ticks)}, str(tmp_path), "1")
    assert not (tmp_path / "base").exists()
    B.build_stocks({"gsheet_finance_data": ticks}, str(tmp_path), "1", fresh_at="2024-02-08 00:00:00")  # a warning only


def test_aviation_books_show(t, tmp_path):
    names = ("airlines", "airports", "routes", "planes")
    assert len(B.build_aviation({n: getattr(I, n)(t) for n in names}, str(tmp_path), "1").tables) == 4
    books = S.books(I.book_docs(t))
    assert B.build_books({"books": books}, str(tmp_path), "1").tables["base_openlibrary_books"].count() == books.count()
    feeds = {
        "character": I.character(t),
        "episode": I.episode(t),
        "location": I.location(t),
        "character__episode": I.character_episode(t),
        "episode__characters": I.episode_characters(t),
        "location__residents": I.location_residents(t),
    }
    b = B.build_show(feeds, str(tmp_path), "1")
    assert b.tables["staging_rm_episodes"].count() == t.orders.count()
    assert {k[0] for k in failures(b)} <= {"base_rm_episode_character", "base_rm_location_residents"}


def test_freshness_report(t):
    feeds = {"gsheet_finance_data": I.stock_ticks(t), "daily_weather": I.daily_weather(t)}
    got = {r.table_name: r.status for r in B.freshness_report(feeds, "2024-02-08 00:00:00").collect()}
    assert got == {"gsheet_finance_data": "warn", "daily_weather": "error"}
    assert set(contracts.FRESHNESS) == {"gsheet_finance_data", "uv_index", "daily_weather"}


def test_reports_of_subjects_without_checks(t, tmp_path):
    b = B.Build(str(tmp_path), "1")
    b.table("base", "unchecked", t.nation)
    assert b.report().count() == 0 and "status" in b.report().columns
    assert B.freshness_report({"nation": t.nation}, "2025-05-01").count() == 0
