"""The warehouse tables as registered queries, over feeds derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import fixed_values as V
from lakeloom.operators.dims import calendar_columns, days_between
from lakeloom.plans import drinks, meals, others, weather
from lakeloom.session import settle
from lakeloom.workload import inputs as I
from lakeloom.workload.registry import Tables, day_sql, key_sql, piece, query, six, six_sql, time_sql

# ---------------------------------------------------------------- drinks

piece(
    "base_beverages",
    f"""SELECT strDrink AS beverage_name, b.idDrink AS beverage_id, source_beverage_type AS beverage_type,
        {key_sql('source_beverage_type', 'source_alcohol_type')} AS beverage_category_sk,
        source_alcohol_type AS alcoholic_type
        FROM beverages_table b LEFT JOIN alcoholic_table a ON a.idDrink = b.idDrink""",
)


@query("base_beverages", "SELECT * FROM base_beverages")
def base_beverages(t: Tables) -> DataFrame:
    return drinks.base_beverages(I.beverages_table(t), I.alcoholic_table(t))


piece(
    "base_beverage_ingredients_lookup",
    """SELECT source_ingredient AS ingredient, idDrink AS beverage_id, strDrink AS beverage_name
       FROM ingredients_table WHERE idDrink IS NOT NULL""",
)


@query("base_beverage_ingredients_lookup", "SELECT * FROM base_beverage_ingredients_lookup")
def base_beverage_ingredients_lookup(t: Tables) -> DataFrame:
    return drinks.base_beverage_ingredients_lookup(I.ingredients_table(t))


piece(
    "base_beverage_consumption",
    """SELECT idDrink AS id_drink, strDrink AS str_drink, strCategory AS str_category,
       strAlcoholic AS str_alcoholic, strGlass AS str_glass, strInstructions AS str_instructions,
       strDrinkThumb AS str_drink_thumb,
       strftime(CAST(dateModified AS TIMESTAMP) AT TIME ZONE 'Australia/Melbourne' AT TIME ZONE 'UTC', '%Y-%m-%d')
           AS date_melbourne, """
    + ", ".join(f"strIngredient{i} AS str_ingredient{i}" for i in range(1, 9))
    + " FROM beverage_fact_data",
)


@query("base_beverage_consumption", "SELECT * FROM base_beverage_consumption")
def base_beverage_consumption(t: Tables) -> DataFrame:
    return drinks.base_beverage_consumption(I.beverage_fact_data(t))


piece(
    "staging_beverage_lookup",
    f"""SELECT beverage_name, beverage_id, beverage_type, {key_sql('beverage_type')} AS beverage_type_sk,
        {key_sql('beverage_type', 'alcoholic_type')} AS beverage_category_sk, alcoholic_type,
        {key_sql('alcoholic_type')} AS alcoholic_type_sk FROM base_beverages""",
)


@query("staging_beverage_lookup", "SELECT * FROM staging_beverage_lookup")
def staging_beverage_lookup(t: Tables) -> DataFrame:
    return drinks.staging_beverage_lookup(base_beverages(t))


@query(
    "glass_type_snapshot",
    f"""SELECT beverage_id, glass_type, glass_type_sk, dbt_scd_id, {time_sql('dbt_updated_at')} AS dbt_updated_at,
        {time_sql('dbt_valid_from')} AS dbt_valid_from, {time_sql('dbt_valid_to')} AS dbt_valid_to
        FROM glass_type_snapshot""",
)
def glass_type_snapshot(t: Tables) -> DataFrame:
    """Three runs; each history is settled, as a run of its own would write it."""
    history = None
    for run_at, glasses in I.glass_tables(t):
        history = drinks.glass_type_snapshot(history, glasses, run_at)
        history = settle(history, "glass-history")
    return history


piece(
    "staging_beverage_consumption",
    """SELECT c.id_drink AS beverage_id, str_drink AS beverage_name, l.beverage_category_sk,
       str_glass AS glass_type, l.beverage_type_sk, l.beverage_type, l.alcoholic_type_sk, l.alcoholic_type,
       str_category, str_alcoholic, g.glass_type_sk, str_instructions AS beverage_instructions,
       str_drink_thumb AS beverage_url, date_melbourne, """
    + ", ".join(f"str_ingredient{i}" for i in range(1, 9))
    + """ FROM base_beverage_consumption c
       LEFT JOIN (SELECT * FROM glass_type_snapshot WHERE dbt_valid_to IS NULL) g ON g.beverage_id = c.id_drink
       LEFT JOIN staging_beverage_lookup l ON l.beverage_id = c.id_drink""",
)


@query("staging_beverage_consumption", "SELECT * FROM staging_beverage_consumption")
def staging_beverage_consumption(t: Tables) -> DataFrame:
    return drinks.staging_beverage_consumption(
        base_beverage_consumption(t), glass_type_snapshot(t), staging_beverage_lookup(t)
    )


@query(
    "fact_beverage_consumption",
    "SELECT * EXCLUDE (str_category, str_alcoholic) FROM staging_beverage_consumption",
)
def fact_beverage_consumption(t: Tables) -> DataFrame:
    return drinks.fact_beverage_consumption(staging_beverage_consumption(t))


@query("dim_alcoholic_type", "SELECT DISTINCT alcoholic_type, alcoholic_type_sk FROM staging_beverage_lookup")
def dim_alcoholic_type(t: Tables) -> DataFrame:
    return drinks.dim_alcoholic_type(staging_beverage_lookup(t))


@query(
    "dim_beverage_type",
    """SELECT DISTINCT beverage_type, alcoholic_type, beverage_category_sk, alcoholic_type_sk
       FROM staging_beverage_lookup""",
)
def dim_beverage_type(t: Tables) -> DataFrame:
    return drinks.dim_beverage_type(staging_beverage_lookup(t))


@query("dim_beverage_glass_type", "SELECT DISTINCT glass_type, glass_type_sk FROM glass_type_snapshot")
def dim_beverage_glass_type(t: Tables) -> DataFrame:
    return drinks.dim_beverage_glass_type(glass_type_snapshot(t))


@query(
    "dim_beverage_ingredient_jointable",
    "SELECT DISTINCT idDrink AS beverage_id FROM ingredients_table WHERE idDrink IS NOT NULL",
)
def dim_beverage_ingredient_jointable(t: Tables) -> DataFrame:
    return drinks.dim_beverage_ingredient_jointable(I.ingredients_table(t))


def _chain(table: str, key: str, item: str, levels: int) -> str:
    """The same table joined to itself level by level, items not repeated."""
    joins = []
    for level in range(2, levels + 1):
        before = ", ".join(f"t{n}.{item}" for n in range(1, level))
        joins.append(f"LEFT JOIN {table} t{level} ON t{level}.{key} = t1.{key} AND t{level}.{item} NOT IN ({before})")
    return f"FROM {table} t1 " + " ".join(joins)


@query(
    "dim_beverage_ingredient_hierarchy",
    "SELECT t1.ingredient, t1.beverage_id, t1.beverage_name, "
    + ", ".join(f"t{n}.ingredient AS ingredient{n}" for n in range(2, 8))
    + " "
    + _chain("base_beverage_ingredients_lookup", "beverage_id", "ingredient", 7),
)
def dim_beverage_ingredient_hierarchy(t: Tables) -> DataFrame:
    return drinks.dim_beverage_ingredient_hierarchy(base_beverage_ingredients_lookup(t))


# ---------------------------------------------------------------- meals

piece(
    "base_meal_category_country",
    f"""SELECT str_meal AS meal_name, c.id_meal AS meal_id, source_country AS country_name,
        {key_sql('source_country', 'source_category')} AS meal_country_category_sk,
        source_category AS category_name
        FROM country_table c LEFT JOIN category_table k ON k.id_meal = c.id_meal""",
)


@query("base_meal_category_country", "SELECT * FROM base_meal_category_country")
def base_meal_category_country(t: Tables) -> DataFrame:
    return meals.base_meal_category_country(I.country_table(t), I.category_table(t))


piece(
    "base_meal_consumption",
    """SELECT id_meal AS meal_id, str_meal AS meal_name, str_category AS category_name, str_area AS country_name,
       str_instructions AS instructions, str_meal_thumb AS meal_image_url, str_youtube AS meal_youtube_url, """
    + ", ".join(f"nullif(str_ingredient{i}, '') AS str_ingredient{i}" for i in range(1, 21))
    + ", str_source AS meal_url FROM consumption",
)


@query("base_meal_consumption", "SELECT * FROM base_meal_consumption")
def base_meal_consumption(t: Tables) -> DataFrame:
    return meals.base_meal_consumption(I.consumption(t))


piece(
    "base_meal_ingredient_table",
    """SELECT str_meal AS meal_name, id_meal AS meal_id, source_ingredient AS ingredient_name
       FROM ingredient_table""",
)


@query("base_meal_ingredient_table", "SELECT * FROM base_meal_ingredient_table")
def base_meal_ingredient_table(t: Tables) -> DataFrame:
    return meals.base_meal_ingredient_table(I.ingredient_table(t))


piece(
    "base_meal_ingredients",
    "SELECT CAST(id_ingredient AS INTEGER) AS ingredient_id, str_ingredient AS ingredient_name FROM ingredients",
)


@query("base_meal_ingredients", "SELECT * FROM base_meal_ingredients")
def base_meal_ingredients(t: Tables) -> DataFrame:
    return meals.base_meal_ingredients(I.ingredients(t))


piece(
    "staging_meal_category_lookup",
    f"""SELECT meal_name, meal_id, category_name, meal_country_category_sk, country_name,
        {key_sql('country_name')} AS meal_country_sk FROM base_meal_category_country""",
)


@query("staging_meal_category_lookup", "SELECT * FROM staging_meal_category_lookup")
def staging_meal_category_lookup(t: Tables) -> DataFrame:
    return meals.staging_meal_category_lookup(base_meal_category_country(t))


piece(
    "staging_meal_consumption",
    """SELECT c.*, l.meal_country_category_sk
       FROM base_meal_consumption c LEFT JOIN staging_meal_category_lookup l ON l.meal_id = c.meal_id""",
)


@query("staging_meal_consumption", "SELECT * FROM staging_meal_consumption")
def staging_meal_consumption(t: Tables) -> DataFrame:
    return meals.staging_meal_consumption(base_meal_consumption(t), staging_meal_category_lookup(t))


@query("fact_meal_consumption", "SELECT * FROM staging_meal_consumption")
def fact_meal_consumption(t: Tables) -> DataFrame:
    return meals.fact_meal_consumption(staging_meal_consumption(t))


piece(
    "staging_meal_ingredients_lookup",
    """SELECT m.meal_name, m.meal_id, m.ingredient_name, i.ingredient_id
       FROM base_meal_ingredient_table m
       LEFT JOIN base_meal_ingredients i ON i.ingredient_name = m.ingredient_name""",
)


@query("staging_meal_ingredients_lookup", "SELECT * FROM staging_meal_ingredients_lookup")
def staging_meal_ingredients_lookup(t: Tables) -> DataFrame:
    return meals.staging_meal_ingredients_lookup(base_meal_ingredient_table(t), base_meal_ingredients(t))


@query(
    "dim_meal_category",
    """SELECT DISTINCT category_name, country_name, meal_country_category_sk
       FROM staging_meal_category_lookup""",
)
def dim_meal_category(t: Tables) -> DataFrame:
    return meals.dim_meal_category(staging_meal_category_lookup(t))


@query("dim_meal_country", "SELECT DISTINCT country_name, meal_country_sk FROM staging_meal_category_lookup")
def dim_meal_country(t: Tables) -> DataFrame:
    return meals.dim_meal_country(staging_meal_category_lookup(t))


@query(
    "dim_meal_ingredient_jointable",
    "SELECT DISTINCT meal_id FROM staging_meal_ingredients_lookup WHERE meal_id IS NOT NULL",
)
def dim_meal_ingredient_jointable(t: Tables) -> DataFrame:
    return meals.dim_meal_ingredient_jointable(staging_meal_ingredients_lookup(t))


@query(
    "dim_meal_ingredient_hierarchy",
    "SELECT t1.meal_id, "
    + ", ".join(f"t{n}.ingredient_name AS ingredient{n}" for n in range(1, 5))
    + " "
    + _chain("staging_meal_ingredients_lookup", "meal_id", "ingredient_id", 4),
)
def dim_meal_ingredient_hierarchy(t: Tables) -> DataFrame:
    return meals.dim_meal_ingredient_hierarchy(staging_meal_ingredients_lookup(t))


# ---------------------------------------------------------------- places, weather, UV

piece(
    "base_geo",
    "SELECT * FROM geo_cities WHERE country IN (" + ", ".join(f"'{c}'" for c in V.GEO_COUNTRIES) + ")",
)


@query("base_geo", "SELECT * FROM base_geo")
def base_geo(t: Tables) -> DataFrame:
    return weather.base_geo(I.geo_cities(t))


piece(
    "staging_geo",
    f"""SELECT * EXCLUDE (continent), {key_sql('city', 'country')} AS city_sk, {key_sql('country')} AS country_sk
        FROM base_geo""",
)


@query("staging_geo", "SELECT * FROM staging_geo")
def staging_geo(t: Tables) -> DataFrame:
    return weather.staging_geo(base_geo(t))


@query("dim_city", "SELECT DISTINCT city, latitude, longitude, region, city_sk, country_sk FROM staging_geo")
def dim_city(t: Tables) -> DataFrame:
    return weather.dim_city(staging_geo(t))


@query("dim_country", "SELECT DISTINCT country_code, country, country_sk FROM staging_geo")
def dim_country(t: Tables) -> DataFrame:
    return weather.dim_country(staging_geo(t))


piece(
    "base_weather",
    """SELECT date AS weather_date, city, temperature_max, temperature_min, temperature_mean, precipitation_sum,
       windspeed_max, windgusts_max, sunshine_duration, location__lat AS latitude, location__lng AS longitude
       FROM daily_weather""",
)


@query("base_weather", f"SELECT * REPLACE ({day_sql('weather_date')} AS weather_date) FROM base_weather")
def base_weather(t: Tables) -> DataFrame:
    return weather.base_weather(I.daily_weather(t))


_ROLLING = [
    "precipitation_fortnightly_anomaly",
    "mean_temp_fortnightly_anomaly",
    "mean_temp_fortnightly_avg",
    "mean_temp_moving_avg",
]
piece(
    "staging_weather",
    f"""SELECT {day_sql('weather_date')} AS weather_date, city, temperature_max, temperature_min,
        temperature_max - temperature_min AS temperature_range, {six_sql('temperature_mean')} AS temperature_mean,
        precipitation_sum,
        {six_sql('precipitation_sum - avg(precipitation_sum) OVER fortnight')} AS precipitation_fortnightly_anomaly,
        windspeed_max, windgusts_max, sunshine_duration, latitude, longitude,
        {six_sql('temperature_mean - avg(temperature_mean) OVER fortnight')} AS mean_temp_fortnightly_anomaly,
        {six_sql('avg(temperature_mean) OVER fortnight')} AS mean_temp_fortnightly_avg,
        {six_sql('temperature_mean - lag(temperature_mean) OVER days')} AS mean_temp_moving_avg
        FROM base_weather
        WINDOW days AS (PARTITION BY city ORDER BY weather_date),
               fortnight AS (PARTITION BY city ORDER BY weather_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: six(F.col(c)) for c in ["temperature_mean", *_ROLLING]})


def _weather_table(t: Tables) -> DataFrame:
    """The base layer as the table it is: aggregated once, read twice by the trailing window."""
    return settle(base_weather(t), "base-weather")


@query("staging_weather", "SELECT * FROM staging_weather")
def staging_weather(t: Tables) -> DataFrame:
    return _rounded(weather.staging_weather(_weather_table(t)))


@query(
    "fact_weather",
    """SELECT w.* EXCLUDE (latitude, longitude), g.city_sk
       FROM staging_weather w LEFT JOIN staging_geo g ON g.city = w.city""",
)
def fact_weather(t: Tables) -> DataFrame:
    staged = weather.staging_weather(_weather_table(t))
    return _rounded(weather.fact_weather(staged, staging_geo(t)))


piece(
    "base_uv",
    """SELECT CAST(uv_time AS DATE) AS uv_date, uv, uv_max, uv_time, ozone, city, location__lat, location__lng
       FROM uv_index""",
)


@query("base_uv", f"SELECT * REPLACE ({day_sql('uv_date')} AS uv_date, {time_sql('uv_time')} AS uv_time) FROM base_uv")
def base_uv(t: Tables) -> DataFrame:
    return weather.base_uv(I.uv_index(t))


_CALENDAR_SQL = """SELECT CAST(d AS DATE) AS date_col, year(d) AS year, month(d) AS month, day(d) AS day,
       strftime(d, '%B') AS month_name, strftime(d, '%A') AS weekday_name, dayofweek(d) AS day_of_week,
       dayofweek(d) IN (0, 6) AS is_weekend, dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year,
       quarter(d) AS quarter"""
piece(
    "order_calendar",
    f"""{_CALENDAR_SQL} FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
        FROM orders)""",
)


def order_calendar(t: Tables) -> DataFrame:
    bounds = t.orders.agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return days_between(bounds, "first", "last").select("date_col", *calendar_columns("date_col"))


@query("dim_date", f"SELECT * REPLACE ({day_sql('date_col')} AS date_col) FROM order_calendar")
def dim_date(t: Tables) -> DataFrame:
    """The calendar over the span of the orders."""
    return order_calendar(t)


@query(
    "staging_uv_data_dates",
    f"""SELECT {day_sql('date_col')} AS date_col FROM order_calendar
        WHERE date_col < DATE '2001-07-20' AND date_col NOT IN (SELECT uv_date FROM base_uv)
        ORDER BY date_col DESC LIMIT 6""",
)
def staging_uv_data_dates(t: Tables) -> DataFrame:
    return weather.staging_uv_data_dates(order_calendar(t), base_uv(t), as_of="2001-07-20")


# ---------------------------------------------------------------- stocks, aviation, books


@query(
    "base_gsheets_finance",
    f"""SELECT id, stock, CAST(CAST(price AS DECIMAL(18,3)) AS DOUBLE) AS price,
        {time_sql("datetime AT TIME ZONE 'Australia/Melbourne' AT TIME ZONE 'UTC'")} AS date_time,
        CAST(round(CAST(high - low AS DECIMAL(38,10)), 2) AS DOUBLE) AS price_spread,
        CAST(round(CAST(price - opened AS DECIMAL(38,10)), 2) AS DOUBLE) AS relative_price_movement,
        CAST(round(CAST(closed - opened AS DECIMAL(38,10)), 2) AS DOUBLE) AS abs_price_movement,
        entries AS num_stock_entries
        FROM (SELECT *, max(price) OVER s AS high, min(price) OVER s AS low, count(id) OVER s AS entries,
                     first(price) OVER whole AS opened, last(price) OVER whole AS closed
              FROM stock_ticks
              WINDOW s AS (PARTITION BY stock),
                     whole AS (PARTITION BY stock ORDER BY datetime, id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        WHERE datetime >= TIMESTAMP '2024-01-20'""",
)
def base_gsheets_finance(t: Tables) -> DataFrame:
    """A second run: the ticks of the first nineteen days are in the table already."""
    ticks = I.stock_ticks(t)
    stored = ticks.where(F.col("datetime") < F.lit("2024-01-20").cast("timestamp"))
    return others.base_gsheets_finance(ticks, stored)


@query(
    "base_openflight_airlines",
    r"""SELECT CAST("Airline ID" AS INTEGER) AS airline_id, "Name" AS airline_name,
        nullif(trim(replace("ICAO", '\n', '')), '') AS icao, nullif(trim(replace("Callsign", '\n', '')), '') AS callsign,
        nullif(trim(replace("Country", '\n', '')), '') AS country, "Active" AS active
        FROM airlines WHERE "Airline ID" <> '-1'""",
)
def base_openflight_airlines(t: Tables) -> DataFrame:
    return others.base_openflight_airlines(I.airlines(t))


@query(
    "base_openflight_airports",
    r"""SELECT "Airport ID" AS "airport id", "Name" AS name, "City" AS city, "Country" AS country,
        nullif("IATA", '\N') AS iata, nullif("ICAO", '\N') AS icao, CAST("Latitude" AS DOUBLE) AS latitude,
        CAST("Longitude" AS DOUBLE) AS longitude, CAST("Altitude" AS INTEGER) AS altitude,
        nullif("Timezone", '\N') AS timezone, nullif("DST", '\N') AS dst,
        nullif("Tz database time zone", '\N') AS database_time_zone FROM airports""",
)
def base_openflight_airports(t: Tables) -> DataFrame:
    return others.base_openflight_airports(I.airports(t))


@query(
    "base_openflight_routes",
    r"""SELECT nullif("Airline ID", '\N') AS "Airline ID", "Source airport" AS source_airport_iata,
        nullif("Destination airport", '\N') AS destination_airport_iata, CAST("Stops" AS INTEGER) AS stops,
        "Equipment" AS equipment FROM routes""",
)
def base_openflight_routes(t: Tables) -> DataFrame:
    return others.base_openflight_routes(I.routes(t))


def _first_rule_sql(rules: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{label}'" for test, label in rules) + f" ELSE '{default}' END"


_MAKER_SQL = _first_rule_sql(
    [(f"\"Name\" ILIKE '{p}%'", label) for p, label in V.MAKER_PREFIXES], V.MAKER_DEFAULT
)


@query(
    "base_openflight_planes",
    rf"""SELECT "Name" AS plane_name, nullif("IATA", '\N') AS iata, nullif("ICAO", '\N') AS icao,
         {_MAKER_SQL} AS manufacturer FROM planes""",
)
def base_openflight_planes(t: Tables) -> DataFrame:
    return others.base_openflight_planes(I.planes(t))


@query(
    "base_openlibrary_books",
    """SELECT search_term, key, title, ebook_access, first_publish_year,
       coalesce(has_fulltext, FALSE) AS has_fulltext, coalesce(len(author_name), 0) AS n_authors,
       coalesce(array_to_string(author_name, ','), '') AS authors, array_to_string(language, ',') AS languages
       FROM book_docs""",
)
def base_openlibrary_books(t: Tables) -> DataFrame:
    """Books as landed; their lists are shown as text."""
    from lakeloom.sources.feeds import books

    rows = others.base_openlibrary_books(books(I.book_docs(t)))
    return rows.select(
        "search_term",
        "key",
        "title",
        "ebook_access",
        "first_publish_year",
        "has_fulltext",
        F.size("authors").alias("n_authors"),
        F.array_join("authors.name", ",").alias("authors"),
        F.array_join("languages.code", ",").alias("languages"),
    )


# ---------------------------------------------------------------- show

_CREATED_SQL = time_sql("created AT TIME ZONE 'Australia/Melbourne' AT TIME ZONE 'UTC'")
piece(
    "base_rm_characters",
    f"""SELECT id AS character_id, name AS character_name, status AS character_status, species AS character_species,
        gender AS character_gender, origin__name AS character_origin, location__name AS character_first_location,
        location__url AS character_first_location_url, image AS character_image, url AS character_url,
        {_CREATED_SQL} AS character_created, _dlt_id AS character_dlt_id FROM character_feed""",
)


@query("base_rm_characters", "SELECT * FROM base_rm_characters")
def base_rm_characters(t: Tables) -> DataFrame:
    return others.base_rm_characters(I.character(t))


piece(
    "base_rm_episodes",
    f"""SELECT id AS episode_id, name AS episode_name, {time_sql("strptime(air_date, '%B %d, %Y')")} AS episode_air_date,
        episode, url AS episode_url, {_CREATED_SQL} AS episode_created, _dlt_id AS episode_dlt_id
        FROM episode_feed""",
)


@query("base_rm_episodes", "SELECT * FROM base_rm_episodes")
def base_rm_episodes(t: Tables) -> DataFrame:
    return others.base_rm_episodes(I.episode(t))


piece(
    "base_rm_locations",
    f"""SELECT id AS location_id, name AS location_name, type AS location_type, dimension AS location_dimension,
        url AS location_url, {_CREATED_SQL} AS location_created, _dlt_id AS location_dlt_id FROM location_feed""",
)


@query("base_rm_locations", "SELECT * FROM base_rm_locations")
def base_rm_locations(t: Tables) -> DataFrame:
    return others.base_rm_locations(I.location(t))


def _links_sql(children: str, parent: str, child: str) -> str:
    return f"""SELECT _dlt_root_id AS {parent}, CAST(regexp_extract(value, '/(\\d+)$', 1) AS INTEGER) AS {child}
               FROM {children}"""


piece("base_rm_character_episode", _links_sql("character_episode", "character_dlt_id", "episode_id"))
piece("base_rm_episode_character", _links_sql("episode_characters", "episode_dlt_id", "character_id"))
piece("base_rm_location_residents", _links_sql("location_residents", "location_dlt_id", "character_id"))


@query("base_rm_character_episode", "SELECT * FROM base_rm_character_episode")
def base_rm_character_episode(t: Tables) -> DataFrame:
    return others.base_rm_character_episode(I.character_episode(t))


@query("base_rm_episode_character", "SELECT * FROM base_rm_episode_character")
def base_rm_episode_character(t: Tables) -> DataFrame:
    return others.base_rm_episode_character(I.episode_characters(t))


@query("base_rm_location_residents", "SELECT * FROM base_rm_location_residents")
def base_rm_location_residents(t: Tables) -> DataFrame:
    return others.base_rm_location_residents(I.location_residents(t))


_LEADS_SQL = _first_rule_sql(
    [(f"regexp_matches(character_name, '^{lead}\\b', 'i')", lead) for lead in V.CHARACTER_LEADS],
    V.CHARACTER_DEFAULT,
)


@query(
    "staging_rm_characters",
    f"""SELECT character_id, character_name, {_LEADS_SQL} AS character_group, character_status, character_species,
        character_gender, character_origin, character_image, character_created, p.character_dlt_id, num_episodes
        FROM base_rm_characters p LEFT JOIN (SELECT character_dlt_id, count(episode_id) AS num_episodes
                                             FROM base_rm_character_episode GROUP BY 1) c
             ON c.character_dlt_id = p.character_dlt_id""",
)
def staging_rm_characters(t: Tables) -> DataFrame:
    return others.staging_rm_characters(base_rm_characters(t), base_rm_character_episode(t))


def _contains_sql(column: str, texts: list[str], word: str) -> str:
    return "(" + f" {word} ".join(f"{column} ILIKE '%{t}%'" for t in texts) + ")"


_EPISODE_SQL = _first_rule_sql(
    [
        (_contains_sql("episode_name", texts, {"any": "OR", "all": "AND"}[mode]), label)
        for label, mode, texts in V.EPISODE_TEXTS
    ],
    V.EPISODE_DEFAULT,
)


@query(
    "staging_rm_episodes",
    f"""SELECT episode_id, episode_name, {_EPISODE_SQL} AS episode_group, episode_air_date, episode,
        CAST(substr(episode, 2, 2) AS INTEGER) AS season_num, CAST(substr(episode, 5, 2) AS INTEGER) AS episode_num,
        p.episode_dlt_id, num_characters
        FROM base_rm_episodes p LEFT JOIN (SELECT episode_dlt_id, count(character_id) AS num_characters
                                           FROM base_rm_episode_character GROUP BY 1) c
             ON c.episode_dlt_id = p.episode_dlt_id""",
)
def staging_rm_episodes(t: Tables) -> DataFrame:
    return others.staging_rm_episodes(base_rm_episodes(t), base_rm_episode_character(t))


_KIND_SQL = _first_rule_sql(
    [
        ("lower(location_type) IN (" + ", ".join(f"'{k}'" for k in kinds) + ")", label)
        for label, kinds in V.LOCATION_TYPES
    ],
    V.LOCATION_DEFAULT,
)
_DIMENSION_SQL = _first_rule_sql(
    [
        (
            _contains_sql("location_dimension", texts, "OR")
            if mode == "contains"
            else f"lower(location_dimension) LIKE '{texts[0]}%'",
            label,
        )
        for label, mode, texts in V.DIMENSION_TEXTS
    ],
    V.DIMENSION_DEFAULT,
)


@query(
    "staging_rm_locations",
    f"""SELECT location_id, location_name, location_type, {_KIND_SQL} AS location_categories, location_dimension,
        {_DIMENSION_SQL} AS dimension_group, location_created, p.location_dlt_id, num_characters
        FROM base_rm_locations p LEFT JOIN (SELECT location_dlt_id, count(character_id) AS num_characters
                                            FROM base_rm_location_residents GROUP BY 1) c
             ON c.location_dlt_id = p.location_dlt_id""",
)
def staging_rm_locations(t: Tables) -> DataFrame:
    return others.staging_rm_locations(base_rm_locations(t), base_rm_location_residents(t))
