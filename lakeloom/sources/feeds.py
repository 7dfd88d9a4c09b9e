"""The ten feeds: landed payloads to the tables the models read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import fixed_values as V
from lakeloom.functions.columns import first_filled, iso_in_zone, last_segment
from lakeloom.operators.planning import after_cursor
from lakeloom.sources import landing as L

# ---------------------------------------------------------------- drinks and meals

DRINK = "idDrink STRING, strDrink STRING, strDrinkThumb STRING"
DRINK_FACT = (
    "idDrink STRING, strDrink STRING, strCategory STRING, strAlcoholic STRING, strGlass STRING, "
    "strInstructions STRING, strDrinkThumb STRING, dateModified STRING, "
    + ", ".join(f"strIngredient{i} STRING" for i in range(1, 9))
)
MEAL = "idMeal STRING, strMeal STRING, strMealThumb STRING"
MEAL_FACT = (
    "idMeal STRING, strMeal STRING, strCategory STRING, strArea STRING, strInstructions STRING, "
    "strMealThumb STRING, strYoutube STRING, strSource STRING, "
    + ", ".join(f"strIngredient{i} STRING" for i in range(1, 21))
)
MEAL_INGREDIENT = "idIngredient STRING, strIngredient STRING"


def drinks_by_tag(spark: SparkSession, path: str) -> DataFrame:
    """Drinks per requested value, tagged by the partition directory (``source_glass=...``)."""
    return L.unwrap(L.read_payloads(spark, path, "drinks"), DRINK)


def drink_draws(spark: SparkSession, path: str) -> DataFrame:
    """Random draws; a drink drawn twice counts twice."""
    return L.unwrap(L.read_payloads(spark, path, "drinks"), DRINK_FACT)


def _snake(df: DataFrame) -> DataFrame:
    """``idMeal`` to ``id_meal``, ``strIngredient12`` to ``str_ingredient12``."""
    import re

    return df.toDF(*[re.sub(r"(?<=[a-z])(?=[A-Z])", "_", c).lower() for c in df.columns])


def meals_by_tag(spark: SparkSession, path: str) -> DataFrame:
    return _snake(L.unwrap(L.read_payloads(spark, path, "meals"), MEAL))


def meal_ingredients(spark: SparkSession, path: str) -> DataFrame:
    return _snake(L.unwrap(L.read_payloads(spark, path, "meals"), MEAL_INGREDIENT))


def meal_draws(spark: SparkSession, path: str) -> DataFrame:
    return _snake(L.unwrap(L.read_payloads(spark, path, "meals"), MEAL_FACT))


# ---------------------------------------------------------------- cities

CITY = "geonameId BIGINT, name STRING, lat DOUBLE, lng DOUBLE, countryName STRING"
CITY_DETAIL = (
    "geonameId BIGINT, countryName STRING, adminName1 STRING, adminCode1 STRING, continentCode STRING"
)


def cities_with_details(cities: DataFrame, details: DataFrame) -> DataFrame:
    """City rows enriched by their detail row; an empty detail country falls back to the city's.

    ``cities`` carries the requested ``country_code``.
    """
    d = details.select(
        "geonameId", F.col("countryName").alias("detail_country"), "adminName1", "adminCode1", "continentCode"
    )
    return cities.join(d, "geonameId", "left").select(
        F.col("geonameId").alias("city_id"),
        F.col("name").alias("city"),
        F.col("lat").alias("latitude"),
        F.col("lng").alias("longitude"),
        first_filled("detail_country", "countryName").alias("country"),
        "country_code",
        F.col("adminName1").alias("region"),
        F.col("adminCode1").alias("region_code"),
        F.col("continentCode").alias("continent"),
    )


def geo_cities(spark: SparkSession, cities_path: str, details_path: str) -> DataFrame:
    cities = L.unwrap(L.read_payloads(spark, cities_path, "geonames"), CITY)
    details = spark.read.schema(CITY_DETAIL).json(details_path, multiLine=True)
    return cities_with_details(cities, details)


# ---------------------------------------------------------------- books

BOOK = (
    "key STRING, title STRING, ebook_access STRING, first_publish_year BIGINT, has_fulltext BOOLEAN, "
    "author_name ARRAY<STRING>, language ARRAY<STRING>"
)


def books(docs: DataFrame) -> DataFrame:
    """Book rows of the search documents; ``search_term`` is the tag of the request."""
    return docs.select(
        "search_term",
        "key",
        "title",
        "ebook_access",
        "first_publish_year",
        F.coalesce("has_fulltext", F.lit(False)).alias("has_fulltext"),
        L.list_of_structs("author_name", "name").alias("authors"),
        L.list_of_structs("language", "code").alias("languages"),
    )


def read_books(spark: SparkSession, path: str) -> DataFrame:
    return books(L.unwrap(L.read_payloads(spark, path, "docs"), BOOK))


def loaded_keys(books_table: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Search term and key of the books whose term was loaded in this run."""
    return books_table.where(F.col("search_term").isin(list(terms))).select("search_term", "key")


def work_ids(books_table: DataFrame) -> DataFrame:
    """Ids of the works behind the books; keys of other kinds are left out."""
    works = books_table.where(F.col("key").startswith("/works/"))
    return works.select(last_segment("key").alias("work_id"))


def subjects(works: DataFrame) -> DataFrame:
    """(work, subject) rows of works with a list of ``subjects``."""
    return L.exploded_values(works, "subjects", "subject", "work_id")


# ---------------------------------------------------------------- show: characters, episodes, places

NAMED_LINK = "STRUCT<name: STRING, url: STRING>"
CHARACTER = (
    "id BIGINT, name STRING, status STRING, species STRING, type STRING, gender STRING, "
    f"origin {NAMED_LINK}, location {NAMED_LINK}, image STRING, episode ARRAY<STRING>, url STRING, "
    "created TIMESTAMP"
)
EPISODE = (
    "id BIGINT, name STRING, air_date STRING, episode STRING, characters ARRAY<STRING>, url STRING, "
    "created TIMESTAMP"
)
LOCATION = (
    "id BIGINT, name STRING, type STRING, dimension STRING, residents ARRAY<STRING>, url STRING, "
    "created TIMESTAMP"
)


def show_tables(spark: SparkSession, path: str, record: str, lists: str) -> tuple[DataFrame, DataFrame]:
    """Parent table (flattened, with row id) and child table of one paginated resource."""
    pages = L.unwrap(L.read_payloads(spark, path, "results"), record)
    rows = L.with_row_id(pages, ["id"])
    return L.flatten_structs(rows.drop(lists)), L.child_table(rows, lists)


# ---------------------------------------------------------------- weather and UV

_DAILY = {
    "temperature_max": "temperature_2m_max",
    "temperature_min": "temperature_2m_min",
    "temperature_mean": "temperature_2m_mean",
    "precipitation_sum": "precipitation_sum",
    "windspeed_max": "windspeed_10m_max",
    "windgusts_max": "windgusts_10m_max",
    "sunshine_duration": "sunshine_duration",
    "uv_index_max": "uv_index_max",
}
WEATHER = (
    "city STRING, lat DOUBLE, lng DOUBLE, daily STRUCT<time: ARRAY<DATE>, "
    + ", ".join(f"{c}: ARRAY<DOUBLE>" for c in _DAILY.values())
    + ">"
)
UV = "city STRING, lat DOUBLE, lng DOUBLE, result STRUCT<uv: DOUBLE, uv_max: DOUBLE, uv_time: TIMESTAMP, ozone: DOUBLE>"


def daily_weather(payloads: DataFrame, load_ts: Column) -> DataFrame:
    """Day rows of payloads that hold one list per measure."""
    lists = {"date": "daily.time"} | {name: f"daily.{c}" for name, c in _DAILY.items()}
    place = F.struct("lat", "lng").alias("location")
    rows = L.zip_lists(payloads, lists, "city", place).withColumn("timestamp", load_ts)
    return L.flatten_structs(rows)


def uv_index(payloads: DataFrame, load_ts: Column) -> DataFrame:
    rows = payloads.select(
        "result.*", "city", F.struct("lat", "lng").alias("location"), load_ts.alias("timestamp")
    )
    return L.flatten_structs(rows)


def stamp_of_place(instant: Column | str, city: str = "city") -> Column:
    """Load stamp as ISO text by the clock of the place that a payload is of; null for a place that is not configured."""
    zones = F.create_map(*[F.lit(x) for name, _, _, zone, _ in V.WEATHER_PLACES for x in (name, zone)])
    return iso_in_zone(instant, F.try_element_at(zones, F.col(city)))


def weather_places(spark: SparkSession, with_uv: bool = False) -> DataFrame:
    """The configured places (a fixed list of fifteen)."""
    places = V.WEATHER_PLACES[: V.UV_PLACES] if with_uv else V.WEATHER_PLACES
    return spark.createDataFrame(places, "city STRING, lat DOUBLE, lng DOUBLE, timezone STRING, country STRING")


# ---------------------------------------------------------------- stock ticks


def stock_ticks(records: DataFrame, time: str = "DateTime") -> DataFrame:
    """Sheet records with their time read as UTC, null where it cannot be read."""
    return records.withColumn(time, L.zoned_times(time))


# ---------------------------------------------------------------- aviation


def aviation_table(spark: SparkSession, kind: str, path: str) -> DataFrame:
    return L.read_csv_checked(spark, path, V.AVIATION_HEADERS[kind])


def aviation_metrics(spark: SparkSession, kind: str, path: str) -> DataFrame:
    return L.read_csv_metrics(spark, path, V.AVIATION_HEADERS[kind])


# ---------------------------------------------------------------- channels

SNIPPET = "STRUCT<title: STRING, description: STRING, publishedAt: STRING, type: STRING>"
STATISTICS = (
    "STRUCT<subscriberCount: STRING, videoCount: STRING, viewCount: STRING, likeCount: STRING, "
    "commentCount: STRING>"
)
CHANNEL_ITEM = (
    f"id STRING, snippet {SNIPPET}, statistics {STATISTICS}, "
    "contentDetails STRUCT<relatedPlaylists: STRUCT<uploads: STRING>>"
)
VIDEO_ITEM = (
    f"snippet {SNIPPET}, statistics {STATISTICS}, "
    "contentDetails STRUCT<videoId: STRING, videoPublishedAt: STRING, duration: STRING>"
)
PLAYLIST_ITEM = f"id STRING, snippet {SNIPPET}, contentDetails STRUCT<itemCount: BIGINT>"
ACTIVITY_ITEM = (
    f"id STRING, snippet {SNIPPET}, contentDetails STRUCT<upload: STRUCT<videoId: STRING>, "
    "addToPlaylist: STRUCT<playlistId: STRING>>"
)


def channels(items: DataFrame) -> DataFrame:
    return items.select(
        "id",
        "snippet.title",
        "snippet.description",
        F.col("snippet.publishedAt").alias("published_at"),
        F.col("statistics.subscriberCount").alias("subscriber_count"),
        F.col("statistics.videoCount").alias("video_count"),
        F.col("statistics.viewCount").alias("view_count"),
        F.col("contentDetails.relatedPlaylists.uploads").alias("uploads_playlist_id"),
    )


def videos(items: DataFrame, cursor: str | None = None) -> DataFrame:
    """Videos published after the cursor; ``items`` carries the ``channel_id`` of its request."""
    rows = items.select(
        F.col("contentDetails.videoId").alias("id"),
        F.col("contentDetails.videoPublishedAt").alias("published_at"),
        "snippet.title",
        "snippet.description",
        "contentDetails.duration",
        F.col("statistics.likeCount").alias("like_count"),
        F.col("statistics.commentCount").alias("comment_count"),
        F.col("statistics.viewCount").alias("view_count"),
        "channel_id",
    )
    return after_cursor(rows, "published_at", cursor)


def playlists(items: DataFrame) -> DataFrame:
    return items.select(
        "id",
        "snippet.title",
        "snippet.description",
        F.col("snippet.publishedAt").alias("published_at"),
        F.col("contentDetails.itemCount").alias("item_count"),
        "channel_id",
    )


def activities(items: DataFrame, cursor: str | None = None) -> DataFrame:
    """Activities after the cursor; the id of a video or playlist only where the type has one."""
    kind = F.col("snippet.type")
    rows = items.select(
        "id",
        "snippet.title",
        kind.alias("type"),
        F.when(kind == "upload", F.col("contentDetails.upload.videoId")).alias("video_id"),
        "snippet.description",
        F.when(kind == "addToPlaylist", F.col("contentDetails.addToPlaylist.playlistId")).alias("playlist_id"),
        F.col("snippet.publishedAt").alias("published_at"),
        "channel_id",
    )
    return after_cursor(rows, "published_at", cursor)
