"""Places, weather and UV: base, staging and common tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import fixed_values as V
from lakeloom.functions.columns import surrogate_key
from lakeloom.operators.dims import dimension
from lakeloom.operators.planning import missing_dates
from lakeloom.operators.windows import trailing

MEASURES = [
    "temperature_max",
    "temperature_min",
    "temperature_mean",
    "precipitation_sum",
    "windspeed_max",
    "windgusts_max",
    "sunshine_duration",
]


def base_geo(geo_cities: DataFrame, countries: Sequence[str] = V.GEO_COUNTRIES) -> DataFrame:
    return geo_cities.where(F.col("country").isin(list(countries))).select(
        "city_id", "city", "latitude", "longitude", "country_code", "country", "region", "continent"
    )


def staging_geo(geo: DataFrame) -> DataFrame:
    return geo.select(
        "city_id",
        "city",
        "latitude",
        "longitude",
        "country_code",
        "country",
        "region",
        surrogate_key("city", "country").alias("city_sk"),
        surrogate_key("country").alias("country_sk"),
    )


def dim_city(places: DataFrame) -> DataFrame:
    return dimension(places, "city", "latitude", "longitude", "region", "city_sk", "country_sk")


def dim_country(places: DataFrame) -> DataFrame:
    return dimension(places, "country_code", "country", "country_sk")


def base_weather(daily_weather: DataFrame) -> DataFrame:
    return daily_weather.select(
        F.col("date").cast("date").alias("weather_date"),
        "city",
        *MEASURES,
        F.col("location__lat").alias("latitude"),
        F.col("location__lng").alias("longitude"),
    )


def base_uv(uv_index: DataFrame) -> DataFrame:
    return uv_index.select(
        F.col("uv_time").cast("date").alias("uv_date"),
        "uv",
        "uv_max",
        "uv_time",
        "ozone",
        "city",
        "location__lat",
        "location__lng",
    )


def staging_weather(weather: DataFrame) -> DataFrame:
    """Daily weather against the mean of the last fourteen rows of its city.

    A city with a very long or dense record is worked on by year, month or day.
    """

    def measures(frame, ordered) -> dict[str, Column]:
        rain, warmth = F.col("precipitation_sum"), F.col("temperature_mean")
        mean_warmth = F.avg(warmth).over(frame)
        return {
            "temperature_range": F.col("temperature_max") - F.col("temperature_min"),
            "precipitation_fortnightly_anomaly": rain - F.avg(rain).over(frame),
            "mean_temp_fortnightly_anomaly": warmth - mean_warmth,
            "mean_temp_fortnightly_avg": mean_warmth,
            "mean_temp_moving_avg": warmth - F.lag(warmth).over(ordered),
        }

    rows = trailing(
        weather,
        keys=["city"],
        order=["weather_date"],
        measures=measures,
        rows=V.TRAILING_ROWS,
    )
    return rows.select(
        "weather_date",
        "city",
        "temperature_max",
        "temperature_min",
        "temperature_range",
        "temperature_mean",
        "precipitation_sum",
        "precipitation_fortnightly_anomaly",
        "windspeed_max",
        "windgusts_max",
        "sunshine_duration",
        "latitude",
        "longitude",
        "mean_temp_fortnightly_anomaly",
        "mean_temp_fortnightly_avg",
        "mean_temp_moving_avg",
    )


def fact_weather(weather: DataFrame, places: DataFrame) -> DataFrame:
    """Weather with the key of its city, found by name; two cities of one name give two rows."""
    keys = places.select("city", "city_sk")
    return weather.join(keys, "city", "left").select(
        "weather_date",
        "city",
        "temperature_max",
        "temperature_min",
        "temperature_range",
        "temperature_mean",
        "precipitation_sum",
        "precipitation_fortnightly_anomaly",
        "windspeed_max",
        "windgusts_max",
        "sunshine_duration",
        "mean_temp_fortnightly_anomaly",
        "mean_temp_fortnightly_avg",
        "mean_temp_moving_avg",
        "city_sk",
    )


def staging_uv_data_dates(dim_date: DataFrame, uv: DataFrame, as_of: str) -> DataFrame:
    """The newest days without UV data, for the next run to fetch."""
    return missing_dates(dim_date, uv, "date_col", "uv_date", as_of)
