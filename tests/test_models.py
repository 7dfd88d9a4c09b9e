"""The warehouse tables on small hand-made feeds with their odd rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.quality import enforce_contract, run_checks
from lakeloom.plans import contracts, drinks, meals, others, weather
from lakeloom.session import settle
from tests.conftest import rows


def test_drinks(spark):
    beverages = spark.createDataFrame(
        [("1", "Tea", "t", "Hot"), ("2", "Gin", "t", "Spirit"), ("3", "Ale", "t", None)],
        "idDrink string, strDrink string, strDrinkThumb string, source_beverage_type string",
    )
    alcoholic = spark.createDataFrame(
        [("1", "Non alcoholic"), ("2", "Alcoholic")], "idDrink string, source_alcohol_type string"
    )
    base = drinks.base_beverages(beverages, alcoholic)
    assert {(r.beverage_id, r.alcoholic_type) for r in base.collect()} == {
        ("1", "Non alcoholic"),
        ("2", "Alcoholic"),
        ("3", None),
    }
    lookup = drinks.staging_beverage_lookup(base)
    assert lookup.where("beverage_id = '3'").select("beverage_category_sk").head() == base.where(
        "beverage_id = '3'"
    ).select("beverage_category_sk").head()
    assert drinks.dim_alcoholic_type(lookup).count() == 3
    assert drinks.dim_beverage_type(lookup).count() == 3
    report = run_checks(base, contracts.CHECKS["base_beverages"])
    assert {r.status for r in report.collect()} == {"pass"}

    glass = spark.createDataFrame([("1", "Mug"), ("2", "Jar")], "idDrink string, source_glass string")
    h = settle(drinks.glass_type_snapshot(None, glass, "2025-05-01 00:00:00"))
    changed = spark.createDataFrame([("1", "Cup")], "idDrink string, source_glass string")
    h = settle(drinks.glass_type_snapshot(h, changed, "2025-05-02 00:00:00"))
    assert rows(drinks.dim_beverage_glass_type(h).select("glass_type")) == [("Cup",), ("Jar",), ("Mug",)]

    fact = spark.createDataFrame(
        [("1", "Tea", "2025-01-01 05:00:00"), ("1", "Tea", None), ("2", "Gin", "2025-07-01 11:00:00"), ("9", "?", None)],
        "idDrink string, strDrink string, dateModified string",
    )
    for c in ["strCategory", "strAlcoholic", "strGlass", "strInstructions", "strDrinkThumb"] + [f"strIngredient{i}" for i in range(1, 9)]:
        fact = fact.withColumn(c, F.lit("x"))
    consumed = drinks.base_beverage_consumption(fact)
    staged = drinks.staging_beverage_consumption(consumed, h, lookup)
    out = drinks.fact_beverage_consumption(staged)
    cup = h.where("glass_type = 'Cup'").head().glass_type_sk
    assert rows(out.select("beverage_id", F.col("date_melbourne").cast("string"), "glass_type_sk", "alcoholic_type")) == sorted(
        [
            ("1", "2024-12-31", cup, "Non alcoholic"),
            ("1", None, cup, "Non alcoholic"),
            ("2", "2025-07-01", None, "Alcoholic"),  # its glass left the source
            ("9", None, None, None),
        ],
        key=repr,
    )
    related = run_checks(consumed, contracts.CHECKS["base_beverage_consumption"], {"base_beverages": base})
    assert rows(related.select("check", "failures")) == [("not_null", 0), ("relationships", 1)]


def test_drink_ingredients(spark):
    table = spark.createDataFrame(
        [("1", "Tea", "leaf"), ("1", "Tea", "milk"), ("2", "Gin", "gin"), (None, None, "void")],
        "idDrink string, strDrink string, source_ingredient string",
    )
    lookup = drinks.base_beverage_ingredients_lookup(table)
    got = drinks.dim_beverage_ingredient_hierarchy(lookup)
    assert got.columns == ["ingredient", "beverage_id", "beverage_name", *[f"ingredient{i}" for i in range(2, 8)]]
    assert rows(got.select("ingredient", "beverage_id", "ingredient2", "ingredient3")) == [
        ("gin", "2", None, None),
        ("leaf", "1", "milk", None),
        ("milk", "1", "leaf", None),
    ]
    assert rows(drinks.dim_beverage_ingredient_jointable(table)) == [("1",), ("2",)]


def test_meals(spark):
    country = spark.createDataFrame([("1", "Pie", "UK"), ("2", "Roo", "AU")], "id_meal string, str_meal string, source_country string")
    category = spark.createDataFrame([("1", "Beef")], "id_meal string, source_category string")
    lookup = meals.staging_meal_category_lookup(meals.base_meal_category_country(country, category))
    assert rows(meals.dim_meal_category(lookup).select("category_name", "country_name")) == [("Beef", "UK"), (None, "AU")]
    assert meals.dim_meal_country(lookup).count() == 2
    draws = spark.createDataFrame([("1", "", "salt"), ("1", "", "salt"), ("8", None, "")], "id_meal string, str_ingredient1 string, str_ingredient2 string")
    for c in ["str_meal", "str_category", "str_area", "str_instructions", "str_meal_thumb", "str_youtube", "str_source"] + [f"str_ingredient{i}" for i in range(3, 21)]:
        draws = draws.withColumn(c, F.lit("x"))
    fact = meals.fact_meal_consumption(meals.staging_meal_consumption(meals.base_meal_consumption(draws), lookup))
    assert rows(fact.select("meal_id", "str_ingredient1", "str_ingredient2", F.col("meal_country_category_sk").isNull())) == [
        ("1", None, "salt", False),
        ("1", None, "salt", False),
        ("8", None, None, True),
    ]


def test_meal_ingredients(spark):
    table = spark.createDataFrame([("m", "1", "salt"), ("m", "1", "beef"), ("m", "1", "dust"), ("n", None, "salt")], "str_meal string, id_meal string, source_ingredient string")
    ids = spark.createDataFrame([("7", "salt"), ("8", "beef")], "id_ingredient string, str_ingredient string")
    lookup = meals.staging_meal_ingredients_lookup(meals.base_meal_ingredient_table(table), meals.base_meal_ingredients(ids))
    got = meals.dim_meal_ingredient_hierarchy(lookup)
    assert rows(got) == sorted(
        [
            ("1", "salt", "beef", None, None),
            ("1", "beef", "salt", None, None),
            ("1", "dust", None, None, None),
            (None, "salt", None, None, None),
        ],
        key=repr,
    )
    assert rows(meals.dim_meal_ingredient_jointable(lookup)) == [("1",)]


def test_places_and_weather(spark):
    cities = spark.createDataFrame(
        [
            (1, "Perth", -31.9, 115.8, "AU", "Australia", "WA", "OC"),
            (2, "Perth", 56.4, -3.4, "GB", "United Kingdom", "Scotland", "EU"),
            (3, "Oslo", 59.9, 10.7, "NO", "Norway", None, "EU"),
        ],
        "city_id bigint, city string, latitude double, longitude double, country_code string, country string, region string, continent string",
    )
    geo = enforce_contract(weather.base_geo(cities), contracts.CONTRACTS["base_geo"])
    places = weather.staging_geo(geo)
    assert weather.dim_city(places).count() == 2 and weather.dim_country(places).count() == 2
    days = spark.range(16).select(
        F.date_add(F.lit("2023-12-25").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("Perth").alias("city"),
        *[F.col("id").cast("double").alias(c) for c in weather.MEASURES],
        F.lit(1.0).alias("location__lat"),
        F.lit(2.0).alias("location__lng"),
    )
    staged = weather.staging_weather(weather.base_weather(days))
    got = {str(r.weather_date): r for r in staged.collect()}
    first, last = got["2023-12-25"], got["2024-01-09"]
    assert (first.mean_temp_moving_avg, first.mean_temp_fortnightly_avg, first.temperature_range) == (None, 0.0, 0.0)
    assert (last.mean_temp_moving_avg, last.mean_temp_fortnightly_avg) == (1.0, 8.5)
    assert last.precipitation_fortnightly_anomaly == 6.5
    # two places of one name: each day twice
    assert weather.fact_weather(staged, places).count() == 32


def test_stocks(spark):
    t = datetime(2025, 5, 1, 10)
    ticks = spark.createDataFrame([(1, "A", 10.0, t), (2, "A", 12.0, t.replace(hour=11))], "id bigint, stock string, price double, datetime timestamp")
    first = settle(others.base_gsheets_finance(ticks.where("id = 1")))
    whole = others.base_gsheets_finance(ticks, first)
    assert rows(whole.select("id", F.col("price_spread").cast("double"), "num_stock_entries")) == [(2, 2.0, 2)]
    assert dict(whole.dtypes)["price"] == "decimal(18,3)"
    batch = others.base_gsheets_finance(ticks, first, windows_over="batch")
    assert rows(batch.select("id", F.col("price_spread").cast("double"), "num_stock_entries")) == [(2, 0.0, 1)]
    with pytest.raises(ValueError):
        others.base_gsheets_finance(ticks, windows_over="other")


def test_show(spark):
    episode = spark.createDataFrame([(1, "Pilot", "December 2, 2013", "S01E01", "u", datetime(2017, 11, 10), "d1"), (2, "Mortyplicity", "June 27, 2021", "S05E02", "u", None, "d2")], "id bigint, name string, air_date string, episode string, url string, created timestamp, _dlt_id string")
    links = spark.createDataFrame([("d1", "https://x/1"), ("d1", "https://x/22")], "_dlt_root_id string, value string")
    staged = others.staging_rm_episodes(others.base_rm_episodes(episode), others.base_rm_episode_character(links))
    assert rows(staged.select("episode_id", "episode_group", "season_num", "episode_num", "num_characters")) == [
        (1, "Other", 1, 1, 2),
        (2, "Morty-Focused", 5, 2, None),
    ]
    location = spark.createDataFrame([(1, "Earth", "Planet", "Dimension C-137", "u", datetime(2017, 11, 10), "l1")], "id bigint, name string, type string, dimension string, url string, created timestamp, _dlt_id string")
    base = enforce_contract(others.base_rm_locations(location), contracts.CONTRACTS["base_rm_locations"])
    staged = others.staging_rm_locations(base, others.base_rm_location_residents(links.limit(0)))
    assert rows(staged.select("location_categories", "dimension_group", "num_characters")) == [("Celestial Body", "Standard Format", None)]
