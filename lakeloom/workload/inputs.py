"""Feeds in the shape the models read, derived from the given tables, in Spark and in SQL.

Every feed reads whole tables. Where a model needs gaps, markers or odd values, they are put in
by attribute (a size, a flag, a segment), so the feeds grow and change with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.columns import row_key
from lakeloom.workload.registry import Tables, piece


def _text(c: str):
    return F.col(c).cast("string")


# ---------------------------------------------------------------- drinks


def beverages_table(t: Tables) -> DataFrame:
    return t.part.select(
        _text("p_partkey").alias("idDrink"),
        F.concat_ws(" ", "p_name", _text("p_partkey")).alias("strDrink"),
        F.col("p_type").alias("source_beverage_type"),
    )


piece(
    "beverages_table",
    """SELECT CAST(p_partkey AS VARCHAR) AS idDrink, p_name || ' ' || p_partkey AS strDrink,
       p_type AS source_beverage_type FROM part""",
)


def alcoholic_table(t: Tables) -> DataFrame:
    kind = (
        F.when(F.col("p_size") < 20, "Non alcoholic")
        .when(F.col("p_size") < 35, "Optional alcohol")
        .otherwise("Alcoholic")
    )
    # small parts have a key that no drink has, so some drinks stay without a match
    key = F.when(F.col("p_size") > 5, _text("p_partkey")).otherwise(F.concat(F.lit("x"), _text("p_partkey")))
    return t.part.select(key.alias("idDrink"), kind.alias("source_alcohol_type"))


piece(
    "alcoholic_table",
    """SELECT CASE WHEN p_size > 5 THEN '' ELSE 'x' END || p_partkey AS idDrink,
       CASE WHEN p_size < 20 THEN 'Non alcoholic' WHEN p_size < 35 THEN 'Optional alcohol'
            ELSE 'Alcoholic' END AS source_alcohol_type
       FROM part""",
)


def glass_tables(t: Tables) -> list[tuple[str, DataFrame]]:
    """Three successive states: keys join and leave by size, promoted parts change and return."""
    row = [_text("p_partkey").alias("idDrink")]
    brand = F.col("p_brand").alias("source_glass")
    changed = F.when(F.col("p_type") == "PROMO", "Mug").otherwise(F.col("p_brand")).alias("source_glass")
    return [
        ("2025-05-01 06:00:00", t.part.where(F.col("p_size") <= 40).select(*row, brand)),
        ("2025-05-02 06:00:00", t.part.where(F.col("p_size") >= 5).select(*row, changed)),
        ("2025-05-03 06:00:00", t.part.select(*row, brand)),
    ]


piece(
    "glass_states",
    """SELECT CAST(p_partkey AS VARCHAR) AS beverage_id, run,
       CASE run WHEN 1 THEN CASE WHEN p_size <= 40 THEN p_brand END
                WHEN 2 THEN CASE WHEN p_size < 5 THEN NULL WHEN p_type = 'PROMO' THEN 'Mug' ELSE p_brand END
                ELSE p_brand END AS glass_type,
       TIMESTAMP '2025-05-01 06:00:00' + to_days(CAST(run - 1 AS INTEGER)) AS run_at
       FROM part CROSS JOIN (VALUES (1), (2), (3)) AS runs(run)""",
)
piece(
    "glass_type_snapshot",
    """SELECT beverage_id, glass_type, md5(glass_type) AS glass_type_sk,
       md5(beverage_id || '|' || CAST(run_at AS VARCHAR)) AS dbt_scd_id,
       run_at AS dbt_updated_at, run_at AS dbt_valid_from,
       min(CASE WHEN other_run > run AND other_type IS DISTINCT FROM glass_type THEN other_at END) AS dbt_valid_to
       FROM (SELECT s.*, o.run AS other_run, o.glass_type AS other_type, o.run_at AS other_at,
                    lag(s.glass_type) OVER (PARTITION BY s.beverage_id, o.run ORDER BY s.run) AS before
             FROM glass_states s JOIN glass_states o USING (beverage_id))
       WHERE glass_type IS NOT NULL AND before IS DISTINCT FROM glass_type
       GROUP BY beverage_id, glass_type, run, run_at""",
)


def ingredients_table(t: Tables) -> DataFrame:
    key = F.when(F.col("l_linenumber") < 7, _text("l_partkey"))
    return t.lineitem.select(
        key.alias("idDrink"),
        F.concat(F.lit("drink "), key).alias("strDrink"),
        F.col("l_returnflag").alias("source_ingredient"),
    ).distinct()


piece(
    "ingredients_table",
    """SELECT DISTINCT CASE WHEN l_linenumber < 7 THEN CAST(l_partkey AS VARCHAR) END AS idDrink,
       'drink ' || CASE WHEN l_linenumber < 7 THEN CAST(l_partkey AS VARCHAR) END AS strDrink,
       l_returnflag AS source_ingredient FROM lineitem""",
)


def beverage_fact_data(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _text("l_partkey").alias("idDrink"),
        F.concat(F.lit("drink "), _text("l_partkey")).alias("strDrink"),
        F.col("l_returnflag").alias("strCategory"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linestatus")).alias("strAlcoholic"),
        F.col("l_linestatus").alias("strGlass"),
        _text("l_orderkey").alias("strInstructions"),
        _text("l_suppkey").alias("strDrinkThumb"),
        F.when(F.col("l_linenumber") > 1, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("dateModified"),
        *[
            F.when(F.col("l_linenumber") >= i, F.concat(F.lit(f"part {i} of "), _text("l_orderkey"))).alias(
                f"strIngredient{i}"
            )
            for i in range(1, 9)
        ],
    )


piece(
    "beverage_fact_data",
    """SELECT CAST(l_partkey AS VARCHAR) AS idDrink, 'drink ' || l_partkey AS strDrink,
       l_returnflag AS strCategory, CASE WHEN l_linenumber > 2 THEN l_linestatus END AS strAlcoholic,
       l_linestatus AS strGlass, CAST(l_orderkey AS VARCHAR) AS strInstructions,
       CAST(l_suppkey AS VARCHAR) AS strDrinkThumb,
       CASE WHEN l_linenumber > 1 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS dateModified, """
    + ", ".join(
        f"CASE WHEN l_linenumber >= {i} THEN 'part {i} of ' || l_orderkey END AS strIngredient{i}"
        for i in range(1, 9)
    )
    + " FROM lineitem",
)

# ---------------------------------------------------------------- meals


def country_table(t: Tables) -> DataFrame:
    return t.customer.select(
        _text("c_custkey").alias("id_meal"),
        F.col("c_name").alias("str_meal"),
        F.concat(F.lit("country "), _text("c_nationkey")).alias("source_country"),
    )


piece(
    "country_table",
    """SELECT CAST(c_custkey AS VARCHAR) AS id_meal, c_name AS str_meal,
       'country ' || c_nationkey AS source_country FROM customer""",
)


def category_table(t: Tables) -> DataFrame:
    # customers in debt go under a key that no meal has
    key = F.when(F.col("c_acctbal") > 0, _text("c_custkey")).otherwise(F.concat(F.lit("x"), _text("c_custkey")))
    return t.customer.select(key.alias("id_meal"), F.col("c_mktsegment").alias("source_category"))


piece(
    "category_table",
    """SELECT CASE WHEN c_acctbal > 0 THEN '' ELSE 'x' END || c_custkey AS id_meal,
       c_mktsegment AS source_category FROM customer""",
)


def ingredient_table(t: Tables) -> DataFrame:
    return t.orders.select(
        F.lit("meal").alias("str_meal"),
        _text("o_custkey").alias("id_meal"),
        F.col("o_orderpriority").alias("source_ingredient"),
    ).distinct()


piece(
    "ingredient_table",
    """SELECT DISTINCT 'meal' AS str_meal, CAST(o_custkey AS VARCHAR) AS id_meal,
       o_orderpriority AS source_ingredient FROM orders""",
)


def ingredients(t: Tables) -> DataFrame:
    # one ingredient is listed under another name, so some meals stay without a match
    name = F.when(F.col("o_orderpriority") == "5-LOW", "unlisted").otherwise(F.col("o_orderpriority"))
    return t.orders.select(
        F.substring("o_orderpriority", 1, 1).alias("id_ingredient"), name.alias("str_ingredient")
    ).distinct()


piece(
    "ingredients",
    """SELECT DISTINCT substr(o_orderpriority, 1, 1) AS id_ingredient,
       CASE o_orderpriority WHEN '5-LOW' THEN 'unlisted' ELSE o_orderpriority END AS str_ingredient FROM orders""",
)


def consumption(t: Tables) -> DataFrame:
    return t.orders.select(
        _text("o_custkey").alias("id_meal"),
        F.concat(F.lit("meal "), _text("o_custkey")).alias("str_meal"),
        F.col("o_orderstatus").alias("str_category"),
        F.col("o_orderpriority").alias("str_area"),
        _text("o_orderkey").alias("str_instructions"),
        F.concat(F.lit("thumb/"), _text("o_orderkey")).alias("str_meal_thumb"),
        F.concat(F.lit("video/"), _text("o_orderkey")).alias("str_youtube"),
        *[
            F.when(F.month("o_orderdate") >= i, F.concat(F.lit(f"{i} of "), _text("o_orderkey")))
            .otherwise("")
            .alias(f"str_ingredient{i}")
            for i in range(1, 21)
        ],
        F.concat(F.lit("meal/"), _text("o_orderkey")).alias("str_source"),
    )


piece(
    "consumption",
    """SELECT CAST(o_custkey AS VARCHAR) AS id_meal, 'meal ' || o_custkey AS str_meal,
       o_orderstatus AS str_category, o_orderpriority AS str_area,
       CAST(o_orderkey AS VARCHAR) AS str_instructions, 'thumb/' || o_orderkey AS str_meal_thumb,
       'video/' || o_orderkey AS str_youtube, """
    + ", ".join(
        f"CASE WHEN month(o_orderdate) >= {i} THEN '{i} of ' || o_orderkey ELSE '' END AS str_ingredient{i}"
        for i in range(1, 21)
    )
    + ", 'meal/' || o_orderkey AS str_source FROM orders",
)

# ---------------------------------------------------------------- places, weather, UV

COUNTRY_BY_REGION = ["New Zealand", "United Kingdom", "Australia", "Canada", "Japan"]
CODE_BY_REGION = ["NZ", "GB", "AU", "CA", "JP"]


def _by_region(names: list[str]):
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col("n_regionkey") + 1)


def geo_cities(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    return t.supplier.join(nations, "s_nationkey").select(
        F.col("s_suppkey").alias("city_id"),
        F.col("s_name").alias("city"),
        (F.col("s_acctbal") / 120).alias("latitude"),
        (F.col("s_acctbal") / 60).alias("longitude"),
        _by_region(CODE_BY_REGION).alias("country_code"),
        _by_region(COUNTRY_BY_REGION).alias("country"),
        F.col("n_name").alias("region"),
        F.lit("OC").alias("continent"),
    )


piece(
    "geo_cities",
    f"""SELECT s_suppkey AS city_id, s_name AS city, s_acctbal / 120 AS latitude, s_acctbal / 60 AS longitude,
       ({CODE_BY_REGION})[n_regionkey + 1] AS country_code,
       ({COUNTRY_BY_REGION})[n_regionkey + 1] AS country, n_name AS region, 'OC' AS continent
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)


def daily_weather(t: Tables) -> DataFrame:
    return (
        t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date"))
        .agg(
            F.max("l_quantity").alias("temperature_max"),
            F.min("l_quantity").alias("temperature_min"),
            F.avg("l_quantity").alias("temperature_mean"),
            F.sum("l_linenumber").cast("double").alias("precipitation_sum"),
            F.max("l_tax").alias("windspeed_max"),
            F.max("l_discount").alias("windgusts_max"),
            F.max("l_extendedprice").alias("sunshine_duration"),
        )
        .select(
            "*",
            F.concat(F.lit("Supplier#"), F.lpad(_text("l_suppkey"), 9, "0")).alias("city"),
            (-F.col("l_suppkey") / 100).alias("location__lat"),
            (F.col("l_suppkey") / 100).alias("location__lng"),
        )
        .drop("l_suppkey")
    )


piece(
    "daily_weather",
    """SELECT CAST(l_shipdate AS DATE) AS date, 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS city,
       max(l_quantity) AS temperature_max, min(l_quantity) AS temperature_min, avg(l_quantity) AS temperature_mean,
       CAST(sum(l_linenumber) AS DOUBLE) AS precipitation_sum, max(l_tax) AS windspeed_max,
       max(l_discount) AS windgusts_max, max(l_extendedprice) AS sunshine_duration,
       -l_suppkey / 100 AS location__lat, l_suppkey / 100 AS location__lng
       FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
)


def uv_index(t: Tables) -> DataFrame:
    return t.orders.select(
        (F.col("o_totalprice") / 50000).alias("uv"),
        (F.col("o_totalprice") / 40000).alias("uv_max"),
        F.col("o_orderdate").alias("uv_time"),
        F.length("o_orderpriority").cast("double").alias("ozone"),
        F.concat(F.lit("city "), _text("o_custkey")).alias("city"),
        F.lit(-33.5).alias("location__lat"),
        F.lit(151.5).alias("location__lng"),
    )


piece(
    "uv_index",
    """SELECT o_totalprice / 50000 AS uv, o_totalprice / 40000 AS uv_max, o_orderdate AS uv_time,
       CAST(length(o_orderpriority) AS DOUBLE) AS ozone, 'city ' || o_custkey AS city,
       CAST(-33.5 AS DOUBLE) AS location__lat, CAST(151.5 AS DOUBLE) AS location__lng FROM orders""",
)

# ---------------------------------------------------------------- stocks


def stock_ticks(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("stock"),
        F.col("value").alias("price"),
        F.col("ts").cast("timestamp").alias("datetime"),
    )


piece(
    "stock_ticks",
    "SELECT event_id AS id, event_type AS stock, value AS price, ts AS datetime FROM events",
)

# ---------------------------------------------------------------- aviation


def airlines(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    code = (
        F.when(segment == "BUILDING", "\\N")
        .when(segment == "FURNITURE", "")
        .when(segment == "MACHINERY", " AB\\n ")
        .otherwise(F.col("c_name"))
    )
    return t.customer.select(
        F.when(F.col("c_acctbal") < 0, "-1").otherwise(_text("c_custkey")).alias("Airline ID"),
        F.col("c_name").alias("Name"),
        code.alias("ICAO"),
        F.concat(F.lit("  "), segment, F.lit(" ")).alias("Callsign"),
        F.when(segment == "HOUSEHOLD", "\\n").otherwise("Oz").alias("Country"),
        F.lit("Y").alias("Active"),
    )


piece(
    "airlines",
    r"""SELECT CASE WHEN c_acctbal < 0 THEN '-1' ELSE CAST(c_custkey AS VARCHAR) END AS "Airline ID",
       c_name AS "Name",
       CASE c_mktsegment WHEN 'BUILDING' THEN '\N' WHEN 'FURNITURE' THEN '' WHEN 'MACHINERY' THEN ' AB\n '
            ELSE c_name END AS "ICAO",
       '  ' || c_mktsegment || ' ' AS "Callsign",
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '\n' ELSE 'Oz' END AS "Country", 'Y' AS "Active"
       FROM customer""",
)


def airports(t: Tables) -> DataFrame:
    def marked(kind: str, value: str):
        return F.when(F.col("p_type") == kind, "\\N").otherwise(F.col(value))

    return t.part.select(
        _text("p_partkey").alias("Airport ID"),
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("City"),
        F.col("p_type").alias("Country"),
        marked("PROMO", "p_brand").alias("IATA"),
        marked("SMALL", "p_name").alias("ICAO"),
        (F.col("p_size") - 25).cast("string").alias("Latitude"),
        (F.col("p_size") * 2).cast("string").alias("Longitude"),
        _text("p_size").alias("Altitude"),
        marked("LARGE", "p_type").alias("Timezone"),
        marked("MEDIUM", "p_type").alias("DST"),
        marked("ECONOMY", "p_type").alias("Tz database time zone"),
    )


piece(
    "airports",
    r"""SELECT CAST(p_partkey AS VARCHAR) AS "Airport ID", p_name AS "Name", p_brand AS "City", p_type AS "Country",
       CASE WHEN p_type = 'PROMO' THEN '\N' ELSE p_brand END AS "IATA",
       CASE WHEN p_type = 'SMALL' THEN '\N' ELSE p_name END AS "ICAO",
       CAST(p_size - 25 AS VARCHAR) AS "Latitude", CAST(p_size * 2 AS VARCHAR) AS "Longitude",
       CAST(p_size AS VARCHAR) AS "Altitude",
       CASE WHEN p_type = 'LARGE' THEN '\N' ELSE p_type END AS "Timezone",
       CASE WHEN p_type = 'MEDIUM' THEN '\N' ELSE p_type END AS "DST",
       CASE WHEN p_type = 'ECONOMY' THEN '\N' ELSE p_type END AS "Tz database time zone" FROM part""",
)


def routes(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.when(F.col("l_linenumber") == 1, "\\N").otherwise(_text("l_partkey")).alias("Airline ID"),
        F.when(F.col("l_linenumber") == 2, "\\N").otherwise(_text("l_suppkey")).alias("Source airport"),
        F.when(F.col("l_linenumber") == 3, "\\N").otherwise(_text("l_orderkey")).alias("Destination airport"),
        _text("l_linenumber").alias("Stops"),
        F.col("l_returnflag").alias("Equipment"),
    )


piece(
    "routes",
    r"""SELECT CASE WHEN l_linenumber = 1 THEN '\N' ELSE CAST(l_partkey AS VARCHAR) END AS "Airline ID",
       CASE WHEN l_linenumber = 2 THEN '\N' ELSE CAST(l_suppkey AS VARCHAR) END AS "Source airport",
       CASE WHEN l_linenumber = 3 THEN '\N' ELSE CAST(l_orderkey AS VARCHAR) END AS "Destination airport",
       CAST(l_linenumber AS VARCHAR) AS "Stops", l_returnflag AS "Equipment" FROM lineitem""",
)

MAKER_BY_TYPE = {
    "STANDARD": "AIRBUS A",
    "PROMO": "Boeing 7",
    "SMALL": "BAe 1",
    "LARGE": "Gulfstream/Rockwell ",
    "ECONOMY": "bell ",
}


def planes(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    lead = F.when(kind == "STANDARD", MAKER_BY_TYPE["STANDARD"])
    for name in ("PROMO", "SMALL", "LARGE", "ECONOMY"):
        lead = lead.when(kind == name, MAKER_BY_TYPE[name])
    return t.part.select(
        F.concat(lead.otherwise(F.col("p_name")), _text("p_size")).alias("Name"),
        F.when(F.col("p_size") < 9, "\\N").otherwise(F.col("p_brand")).alias("IATA"),
        F.when(F.col("p_size") > 40, "\\N").otherwise(F.col("p_brand")).alias("ICAO"),
    )


piece(
    "planes",
    "SELECT CASE p_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MAKER_BY_TYPE.items())
    + r""" ELSE p_name END || p_size AS "Name", CASE WHEN p_size < 9 THEN '\N' ELSE p_brand END AS "IATA",
       CASE WHEN p_size > 40 THEN '\N' ELSE p_brand END AS "ICAO" FROM part""",
)

# ---------------------------------------------------------------- books


def book_docs(t: Tables) -> DataFrame:
    kind = F.when(F.col("lang") == "de", "/books/OL").otherwise("/works/OL")
    return t.documents.select(
        F.col("source").alias("search_term"),
        F.concat(kind, _text("doc_id")).alias("key"),
        F.col("text").alias("title"),
        F.col("lang").alias("ebook_access"),
        F.col("n_chars").alias("first_publish_year"),
        F.when(F.col("n_chars") > 1000, F.lit(True)).alias("has_fulltext"),
        F.when(F.col("lang") != "fr", F.array("source", "lang")).alias("author_name"),
        F.array("lang").alias("language"),
    )


piece(
    "book_docs",
    """SELECT source AS search_term,
       CASE WHEN lang = 'de' THEN '/books/OL' ELSE '/works/OL' END || doc_id AS key, text AS title,
       lang AS ebook_access, n_chars AS first_publish_year,
       CASE WHEN n_chars > 1000 THEN TRUE END AS has_fulltext,
       CASE WHEN lang <> 'fr' THEN [source, lang] END AS author_name, [lang] AS language FROM documents""",
)

# ---------------------------------------------------------------- show

NAME_BY_SEGMENT = {
    "BUILDING": "RICK Sanchez ",
    "FURNITURE": "Rickety ",
    "MACHINERY": "morty-",
    "HOUSEHOLD": "Summer ",
}


def _first_seen(key: str):
    start = F.lit("2017-11-04 18:48:46").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.col(key).cast("int"), start).cast("timestamp")


def character(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    lead = F.when(segment == "BUILDING", NAME_BY_SEGMENT["BUILDING"])
    for name in ("FURNITURE", "MACHINERY", "HOUSEHOLD"):
        lead = lead.when(segment == name, NAME_BY_SEGMENT[name])
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.concat(lead.otherwise("Jerry"), F.when(segment != "AUTOMOBILE", _text("c_custkey")).otherwise("")).alias("name"),
        F.when(F.col("c_acctbal") < 0, "Dead").otherwise("Alive").alias("status"),
        segment.alias("species"),
        F.lit("unknown").alias("gender"),
        F.concat(F.lit("origin "), _text("c_nationkey")).alias("origin__name"),
        F.concat(F.lit("place "), _text("c_nationkey")).alias("location__name"),
        F.concat(F.lit("place/"), _text("c_nationkey")).alias("location__url"),
        F.concat(F.lit("image/"), _text("c_custkey")).alias("image"),
        F.concat(F.lit("character/"), _text("c_custkey")).alias("url"),
        _first_seen("c_custkey").alias("created"),
        row_key("c_custkey").alias("_dlt_id"),
    )


piece(
    "character_feed",
    "SELECT c_custkey AS id, CASE c_mktsegment "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAME_BY_SEGMENT.items())
    + """ ELSE 'Jerry' END || CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN CAST(c_custkey AS VARCHAR) ELSE '' END AS name,
       CASE WHEN c_acctbal < 0 THEN 'Dead' ELSE 'Alive' END AS status, c_mktsegment AS species,
       'unknown' AS gender, 'origin ' || c_nationkey AS origin__name, 'place ' || c_nationkey AS location__name,
       'place/' || c_nationkey AS location__url, 'image/' || c_custkey AS image, 'character/' || c_custkey AS url,
       TIMESTAMP '2017-11-04 18:48:46' + to_seconds(c_custkey) AS created,
       sha256(CAST(c_custkey AS VARCHAR)) AS _dlt_id FROM customer""",
)


def character_episode(t: Tables) -> DataFrame:
    # the orders of one customer in five go to a parent that is not there
    parent = F.when(F.col("o_custkey") % 5 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return t.orders.select(
        row_key(parent).alias("_dlt_root_id"),
        F.concat(F.lit("https://show/api/episode/"), _text("o_orderkey")).alias("value"),
    )


piece(
    "character_episode",
    """SELECT sha256(CAST(CASE WHEN o_custkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS VARCHAR)) AS _dlt_root_id,
       'https://show/api/episode/' || o_orderkey AS value FROM orders""",
)

TITLE_BY_PRIORITY = {
    "1-URGENT": "The RICKLANTIS Mixup ",
    "2-HIGH": "Rick and Mort ",
    "3-MEDIUM": "Rixty Minutes ",
    "4-NOT SPECIFIED": "Total Rickall recall ",
}


def episode(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    title = F.when(priority == "1-URGENT", TITLE_BY_PRIORITY["1-URGENT"])
    for name in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"):
        title = title.when(priority == name, TITLE_BY_PRIORITY[name])
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(title.otherwise("Pilot "), _text("o_orderkey")).alias("name"),
        F.date_format("o_orderdate", "MMMM dd, yyyy").alias("air_date"),
        F.concat(
            F.lit("S"), F.date_format("o_orderdate", "yy"), F.lit("E"), F.date_format("o_orderdate", "MM")
        ).alias("episode"),
        F.concat(F.lit("episode/"), _text("o_orderkey")).alias("url"),
        _first_seen("o_orderkey").alias("created"),
        row_key("o_orderkey").alias("_dlt_id"),
    )


piece(
    "episode_feed",
    "SELECT o_orderkey AS id, CASE o_orderpriority "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TITLE_BY_PRIORITY.items())
    + """ ELSE 'Pilot ' END || o_orderkey AS name, strftime(o_orderdate, '%B %d, %Y') AS air_date,
       strftime(o_orderdate, 'S%yE%m') AS episode, 'episode/' || o_orderkey AS url,
       TIMESTAMP '2017-11-04 18:48:46' + to_seconds(o_orderkey) AS created,
       sha256(CAST(o_orderkey AS VARCHAR)) AS _dlt_id FROM orders""",
)


def episode_characters(t: Tables) -> DataFrame:
    # the lines of one order in seven go to a parent that is not there
    parent = F.when(F.col("l_orderkey") % 7 == 0, -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    pairs = t.lineitem.select(parent.alias("parent"), "l_partkey").distinct()  # numbers, before they become long texts
    return pairs.select(
        row_key("parent").alias("_dlt_root_id"),
        F.concat(F.lit("https://show/api/character/"), _text("l_partkey")).alias("value"),
    )


piece(
    "episode_characters",
    """SELECT DISTINCT sha256(CAST(CASE WHEN l_orderkey % 7 = 0 THEN -1 - l_orderkey ELSE l_orderkey END AS VARCHAR)) AS _dlt_root_id,
       'https://show/api/character/' || l_partkey AS value FROM lineitem""",
)

PLACE_KINDS = ["Planet", "TV", "spa", "Box", "QUADRANT", "Hell", "Country", None]
PLACE_DIMENSIONS = ["unknown", "Dimension C-137", "dimension D-99", "Fascist Shrimp", "Pizza", "Replacement", None]


def location(t: Tables) -> DataFrame:
    def pick(values: list, by: str):
        listed = F.array(*[F.lit(v).cast("string") for v in values])
        return F.element_at(listed, F.pmod(F.col(by), F.lit(len(values))).cast("int") + 1)

    return t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        pick(PLACE_KINDS, "s_nationkey").alias("type"),
        pick(PLACE_DIMENSIONS, "s_suppkey").alias("dimension"),
        F.concat(F.lit("location/"), _text("s_suppkey")).alias("url"),
        _first_seen("s_suppkey").alias("created"),
        row_key("s_suppkey").alias("_dlt_id"),
    )


def _listed(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


piece(
    "location_feed",
    f"""SELECT s_suppkey AS id, s_name AS name,
       ({_listed(PLACE_KINDS)})[s_nationkey % {len(PLACE_KINDS)} + 1] AS type,
       ({_listed(PLACE_DIMENSIONS)})[s_suppkey % {len(PLACE_DIMENSIONS)} + 1] AS dimension,
       'location/' || s_suppkey AS url, TIMESTAMP '2017-11-04 18:48:46' + to_seconds(s_suppkey) AS created,
       sha256(CAST(s_suppkey AS VARCHAR)) AS _dlt_id FROM supplier""",
)


def location_residents(t: Tables) -> DataFrame:
    # the lines of one supplier in four go to a place that is not there
    parent = F.when(F.col("l_suppkey") % 4 == 0, -1 - F.col("l_suppkey")).otherwise(F.col("l_suppkey"))
    pairs = t.lineitem.select(parent.alias("parent"), "l_partkey").distinct()  # numbers, before they become long texts
    return pairs.select(
        row_key("parent").alias("_dlt_root_id"),
        F.concat(F.lit("https://show/api/character/"), _text("l_partkey")).alias("value"),
    )


piece(
    "location_residents",
    """SELECT DISTINCT sha256(CAST(CASE WHEN l_suppkey % 4 = 0 THEN -1 - l_suppkey ELSE l_suppkey END AS VARCHAR)) AS _dlt_root_id,
       'https://show/api/character/' || l_partkey AS value FROM lineitem""",
)
