"""Checks, contracts and freshness limits of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

from lakeloom.functions import fixed_values as V
from lakeloom.operators.quality import Accepted, Between, NotNull, Related, Unique


def _key(column: str) -> list:
    return [NotNull(column), Unique(column)]


def _place(latitude: str, longitude: str) -> list:
    return [Between(latitude, -90, 90), Between(longitude, -180, 180)]


CHECKS = {
    "gsheet_finance_data": _key("id"),
    "base_beverage_consumption": [
        NotNull("id_drink"),
        Related("id_drink", "base_beverages", "beverage_id"),
    ],
    "base_beverage_ingredients_lookup": [Unique("ingredient", "beverage_id")],
    "base_beverages": [
        *_key("beverage_name"),
        *_key("beverage_id"),
        Accepted("alcoholic_type", tuple(V.ALCOHOLIC_TYPES)),
    ],
    "base_geo": [
        *_key("city_id"),
        *_place("latitude", "longitude"),
        Accepted("country_code", tuple(V.COUNTRY_CODES)),
    ],
    "base_gsheets_finance": _key("id"),
    "base_meal_category_country": _key("meal_id"),
    "base_meal_consumption": [
        NotNull("meal_id"),
        Related("meal_id", "base_meal_category_country", "meal_id"),
    ],
    "base_meal_ingredient_table": [Unique("ingredient_name", "meal_id")],
    "base_meal_ingredients": _key("ingredient_id"),
    "base_rm_character_episode": [Unique("character_dlt_id", "episode_id")],
    "base_rm_characters": [
        *_key("character_id"),
        Accepted("character_status", tuple(V.CHARACTER_STATUSES)),
        Accepted("character_gender", tuple(V.CHARACTER_GENDERS)),
    ],
    "base_rm_episode_character": [Unique("episode_dlt_id", "character_id")],
    "base_rm_episodes": _key("episode_id"),
    "base_rm_location_residents": [Unique("location_dlt_id", "character_id")],
    "base_rm_locations": _key("location_id"),
    "base_uv": [
        Unique("uv_time", "city"),
        Related("city", "base_geo", "city"),
        *_place("location__lat", "location__lng"),
    ],
    "base_weather": [
        Unique("weather_date", "city"),
        Related("city", "base_geo", "city"),
        *_place("latitude", "longitude"),
    ],
    # History repeats a key once per version, so these run on the open rows.
    "glass_type_snapshot": _key("beverage_id"),
    "dim_city": _key("city_sk"),
    "dim_country": _key("country_sk"),
    "dim_date": _key("date_col"),
    "dim_meal_category": _key("meal_country_category_sk"),
}

CONTRACTS = {
    "base_geo": T.StructType(
        [
            T.StructField("city_id", T.LongType()),
            T.StructField("city", T.StringType()),
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("country_code", T.StringType()),
            T.StructField("country", T.StringType()),
            T.StructField("region", T.StringType()),
            T.StructField("continent", T.StringType()),
        ]
    ),
    "base_rm_locations": T.StructType(
        [
            T.StructField("location_id", T.LongType()),
            T.StructField("location_name", T.StringType()),
            T.StructField("location_type", T.StringType()),
            T.StructField("location_dimension", T.StringType()),
            T.StructField("location_url", T.StringType()),
            T.StructField("location_created", T.TimestampType()),
            T.StructField("location_dlt_id", T.StringType()),
        ]
    ),
}

#: table -> (column that says when a row was loaded, days until a warning, days until an error)
FRESHNESS = {
    "gsheet_finance_data": ("datetime", 7, 14),
    "uv_index": ("timestamp", 3, 9),
    "daily_weather": ("date", 2, 5),
}
