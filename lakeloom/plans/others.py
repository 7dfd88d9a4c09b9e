"""Stocks, aviation, books and the show: base and staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.operators.joins import attach_counts
from lakeloom.operators.merge import new_rows
from lakeloom.operators.windows import price_movement

# ---------------------------------------------------------------- stocks


def base_gsheets_finance(
    ticks: DataFrame, target: DataFrame | None = None, windows_over: str = "history"
) -> DataFrame:
    """Ticks not yet in ``target``, with the price movement of their stock.

    ``windows_over="history"`` measures over all ticks; ``"batch"`` only over the new ones.
    """
    if windows_over not in ("history", "batch"):
        raise ValueError("windows_over is 'history' or 'batch'")
    if windows_over == "batch":
        measured = price_movement(new_rows(target, ticks, ["id"]))
    else:
        measured = new_rows(target, price_movement(ticks), ["id"])
    return measured.select(
        "id",
        "stock",
        F.col("price").cast("decimal(18,3)").alias("price"),
        C.reinterpret_utc_as("datetime").alias("date_time"),
        "price_spread",
        "relative_price_movement",
        "abs_price_movement",
        "num_stock_entries",
    )


# ---------------------------------------------------------------- aviation


def base_openflight_airlines(airlines: DataFrame) -> DataFrame:
    return airlines.where(F.col("Airline ID") != "-1").select(
        F.col("Airline ID").cast("int").alias("airline_id"),
        F.col("Name").alias("airline_name"),
        C.clean_text("ICAO").alias("icao"),
        C.clean_text("Callsign").alias("callsign"),
        C.clean_text("Country").alias("country"),
        F.col("Active").alias("active"),
    )


def base_openflight_airports(airports: DataFrame) -> DataFrame:
    return airports.select(
        F.col("Airport ID").alias("airport id"),
        F.col("Name").alias("name"),
        F.col("City").alias("city"),
        F.col("Country").alias("country"),
        C.null_marker("IATA").alias("iata"),
        C.null_marker("ICAO").alias("icao"),
        F.col("Latitude").cast("double").alias("latitude"),
        F.col("Longitude").cast("double").alias("longitude"),
        F.col("Altitude").cast("int").alias("altitude"),
        C.null_marker("Timezone").alias("timezone"),
        C.null_marker("DST").alias("dst"),
        C.null_marker("Tz database time zone").alias("database_time_zone"),
    )


def base_openflight_routes(routes: DataFrame) -> DataFrame:
    return routes.select(
        C.null_marker("Airline ID").alias("Airline ID"),
        F.col("Source airport").alias("source_airport_iata"),
        C.null_marker("Destination airport").alias("destination_airport_iata"),
        F.col("Stops").cast("int").alias("stops"),
        F.col("Equipment").alias("equipment"),
    )


def base_openflight_planes(planes: DataFrame) -> DataFrame:
    return planes.select(
        F.col("Name").alias("plane_name"),
        C.null_marker("IATA").alias("iata"),
        C.null_marker("ICAO").alias("icao"),
        C.aircraft_maker("Name").alias("manufacturer"),
    )


# ---------------------------------------------------------------- books


def base_openlibrary_books(books: DataFrame) -> DataFrame:
    return books


# ---------------------------------------------------------------- show


def base_rm_characters(character: DataFrame) -> DataFrame:
    return character.select(
        F.col("id").alias("character_id"),
        F.col("name").alias("character_name"),
        F.col("status").alias("character_status"),
        F.col("species").alias("character_species"),
        F.col("gender").alias("character_gender"),
        F.col("origin__name").alias("character_origin"),
        F.col("location__name").alias("character_first_location"),
        F.col("location__url").alias("character_first_location_url"),
        F.col("image").alias("character_image"),
        F.col("url").alias("character_url"),
        C.reinterpret_utc_as("created").alias("character_created"),
        F.col("_dlt_id").alias("character_dlt_id"),
    )


def base_rm_episodes(episode: DataFrame) -> DataFrame:
    return episode.select(
        F.col("id").alias("episode_id"),
        F.col("name").alias("episode_name"),
        C.long_date("air_date").alias("episode_air_date"),
        "episode",
        F.col("url").alias("episode_url"),
        C.reinterpret_utc_as("created").alias("episode_created"),
        F.col("_dlt_id").alias("episode_dlt_id"),
    )


def base_rm_locations(location: DataFrame) -> DataFrame:
    return location.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        F.col("type").alias("location_type"),
        F.col("dimension").alias("location_dimension"),
        F.col("url").alias("location_url"),
        C.reinterpret_utc_as("created").alias("location_created"),
        F.col("_dlt_id").alias("location_dlt_id"),
    )


def _links(children: DataFrame, parent_alias: str, id_alias: str) -> DataFrame:
    return children.select(
        F.col("_dlt_root_id").alias(parent_alias), C.trailing_id("value").alias(id_alias)
    )


def base_rm_character_episode(character__episode: DataFrame) -> DataFrame:
    return _links(character__episode, "character_dlt_id", "episode_id")


def base_rm_episode_character(episode__characters: DataFrame) -> DataFrame:
    return _links(episode__characters, "episode_dlt_id", "character_id")


def base_rm_location_residents(location__residents: DataFrame) -> DataFrame:
    return _links(location__residents, "location_dlt_id", "character_id")


def staging_rm_characters(characters: DataFrame, character_episode: DataFrame) -> DataFrame:
    counted = attach_counts(characters, character_episode, "character_dlt_id", "episode_id", "num_episodes")
    return counted.select(
        "character_id",
        "character_name",
        C.character_group("character_name").alias("character_group"),
        "character_status",
        "character_species",
        "character_gender",
        "character_origin",
        "character_image",
        "character_created",
        "character_dlt_id",
        "num_episodes",
    )


def staging_rm_episodes(episodes: DataFrame, episode_character: DataFrame) -> DataFrame:
    counted = attach_counts(episodes, episode_character, "episode_dlt_id", "character_id", "num_characters")
    return counted.select(
        "episode_id",
        "episode_name",
        C.episode_group("episode_name").alias("episode_group"),
        "episode_air_date",
        "episode",
        C.code_number("episode", 2, 2).alias("season_num"),
        C.code_number("episode", 5, 2).alias("episode_num"),
        "episode_dlt_id",
        "num_characters",
    )


def staging_rm_locations(locations: DataFrame, location_residents: DataFrame) -> DataFrame:
    counted = attach_counts(locations, location_residents, "location_dlt_id", "character_id", "num_characters")
    return counted.select(
        "location_id",
        "location_name",
        "location_type",
        C.location_category("location_type").alias("location_categories"),
        "location_dimension",
        C.dimension_group("location_dimension").alias("dimension_group"),
        "location_created",
        "location_dlt_id",
        "num_characters",
    )
