"""The operators as registered queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.functions import fixed_values as V
from lakeloom.operators import (
    changes,
    dims,
    history,
    joins,
    merge,
    permute,
    planning,
    presence,
    quality,
    refresh,
    summaries,
    versioned,
    windows,
)
from lakeloom.session import scratch_path, settle
from lakeloom.sinks import publish as sink
from lakeloom.sources import envelopes, feeds, landing, records
from lakeloom.streaming import ingest
from lakeloom.workload.registry import Tables, day_sql, key_sql, piece, query, six, six_sql, time_sql


def _text(c: str):
    return F.col(c).cast("string")


def _at(day: str):
    return F.lit(day).cast("timestamp_ntz")


# ================================================================ readers


def _csv_text(t: Tables) -> DataFrame:
    """Lines of a header-less file: quoted names, doubled quotes, short, long and empty lines."""
    segment = F.col("c_mktsegment")
    plain = F.concat_ws(",", _text("c_custkey"), "c_name", segment)
    return t.customer.select(
        F.when(segment == "BUILDING", F.concat_ws(",", _text("c_custkey"), F.concat(F.lit('"'), "c_name", F.lit(', ""B"""')), segment))
        .when(segment == "FURNITURE", F.concat(plain, F.lit(",extra")))
        .when(segment == "MACHINERY", F.concat_ws(",", _text("c_custkey"), F.concat(F.lit('"'), "c_name", F.lit('\\"x"')), F.lit("\\N")))
        .when((segment == "HOUSEHOLD") & (F.col("c_acctbal") < 0), F.lit(""))
        .otherwise(plain)
        .alias("value")
    )


@query(
    "csv_checked_rows",
    r"""SELECT CAST(c_custkey AS VARCHAR) AS id,
        CASE c_mktsegment WHEN 'BUILDING' THEN c_name || ', "B"' WHEN 'MACHINERY' THEN c_name || '\x"'
             ELSE c_name END AS name,
        CASE c_mktsegment WHEN 'MACHINERY' THEN '\N' ELSE c_mktsegment END AS segment
        FROM customer
        WHERE c_mktsegment <> 'FURNITURE' AND NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0)""",
)
def csv_checked_rows(t: Tables) -> DataFrame:
    return landing.csv_rows(_csv_text(t), ["id", "name", "segment"])


@query(
    "csv_load_metrics",
    """SELECT count(*) AS row_count,
       count(*) FILTER (c_mktsegment = 'FURNITURE' OR (c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0)) AS malformed_rows,
       'id, name, segment' AS headers FROM customer""",
)
def csv_load_metrics(t: Tables) -> DataFrame:
    return landing.csv_metrics(_csv_text(t), ["id", "name", "segment"])


@query(
    "large_envelopes",
    """SELECT c_custkey AS id, c_name || '}, {' || c_mktsegment AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer""",
)
def large_envelopes(t: Tables) -> DataFrame:
    """Payloads of one object each, whose list is cut at item borders by the tasks that read the file."""
    landed = scratch_path(t.spark, "landed-json")
    segment = F.col("c_mktsegment")
    item = F.struct(
        F.col("c_custkey").alias("id"),
        F.concat("c_name", F.lit("}, {"), segment).alias("name"),
        F.struct(segment.alias("segment"), F.array(F.struct(F.col("c_acctbal").alias("balance"))).alias("kept")).alias("more"),
    )
    lines = t.customer.select(
        F.pmod("c_custkey", F.lit(3)).alias("payload"), F.lit(1).alias("place"), F.concat(F.to_json(item), F.lit(",")).alias("value")
    )
    ends = [(p, place, text) for p in range(3) for place, text in ((0, '{"meta": [{"id": -1}], "drinks": ['), (2, '"None Found"], "n": {"drinks": []}}'))]
    whole = lines.unionByName(t.spark.createDataFrame(ends, "payload long, place int, value string"))
    ordered = whole.repartition("payload").sortWithinPartitions("payload", "place")
    ordered.select("payload", "value").write.partitionBy("payload").text(landed)
    record = "id LONG, name STRING, more STRUCT<segment: STRING, kept: ARRAY<STRUCT<balance: DOUBLE>>>"
    found = envelopes.read_envelope(t.spark, landed, "drinks", record)
    return found.select("id", "name", "more.segment", F.col("more.kept")[0]["balance"].alias("balance"))


@query(
    "load_lineage",
    """SELECT 'customer' AS table_name, load_id, count(*) AS row_count
       FROM (SELECT CASE WHEN c_acctbal < 0 THEN 'load-2' ELSE 'load-1' END AS load_id FROM customer)
       GROUP BY ALL""",
)
def load_lineage(t: Tables) -> DataFrame:
    """Two loads merged into one table: what each of them has left there."""
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    first = landing.with_lineage(rows, ["c_custkey"], "load-1")
    again = landing.with_lineage(rows.where("c_acctbal < 0"), ["c_custkey"], "load-2")
    return landing.loads_of(merge.merge_by_key(first, again, ["_dlt_id"], ["_dlt_load_id"]), "customer")


@query(
    "csv_records_file",
    r"""SELECT CAST(c_custkey AS VARCHAR) AS id,
        CASE c_mktsegment WHEN 'BUILDING' THEN c_name || chr(10) || 'of "B",' || chr(10) WHEN 'MACHINERY' THEN c_name || '"x'
             ELSE c_name END AS name, c_mktsegment AS segment
        FROM customer WHERE c_mktsegment <> 'FURNITURE'""",
)
def csv_records_file(t: Tables) -> DataFrame:
    """Landed files whose quoted fields hold line breaks, commas and quotes."""
    landed = scratch_path(t.spark, "landed-csv")
    segment = F.col("c_mktsegment")
    quoted = F.concat(F.lit('"'), "c_name", F.lit('\nof ""B"",\n"'))
    name = F.when(segment == "BUILDING", quoted).when(segment == "MACHINERY", F.concat("c_name", F.lit('"x'))).otherwise(F.col("c_name"))
    more = F.when(segment == "FURNITURE", ",extra").otherwise("")
    t.customer.select(F.concat(_text("c_custkey"), F.lit(","), name, F.lit(","), segment, more)).write.text(landed)
    return records.read_csv_records(t.spark, landed, ["id", "name", "segment"])


@query(
    "csv_load_observed",
    """SELECT count(*) AS row_count,
       count(*) FILTER (c_mktsegment = 'FURNITURE' OR (c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0)) AS malformed_rows,
       'id, name, segment' AS headers,
       count(*) FILTER (c_mktsegment <> 'FURNITURE' AND NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0)) AS stored
       FROM customer""",
)
def csv_load_observed(t: Tables) -> DataFrame:
    """The numbers of a load, counted while it writes, beside the rows it stored."""
    to = scratch_path(t.spark, "loaded-csv")
    found = landing.load_csv(_csv_text(t), ["id", "name", "segment"], to)
    return t.spark.read.parquet(to).agg(
        F.lit(found["row_count"]).alias("row_count"),
        F.lit(found["malformed_rows"]).alias("malformed_rows"),
        F.lit(found["headers"]).alias("headers"),
        F.count(F.lit(1)).alias("stored"),
    )


@query(
    "table_metrics",
    """SELECT 'events' AS table_name, count(*) AS row_count, 'event_id, ts, user_id, event_type, value, props' AS columns
       FROM events
       UNION ALL SELECT 'labels', count(*), 'doc_id, quality, toxic' FROM labels
       UNION ALL SELECT 'conversations', count(*), 'conv_id, turn, role, text' FROM conversations""",
)
def table_metrics(t: Tables) -> DataFrame:
    logs = [landing.table_metrics(getattr(t, name), name) for name in ("events", "labels", "conversations")]
    return logs[0].unionByName(logs[1]).unionByName(logs[2])


def _envelopes(t: Tables) -> DataFrame:
    """One payload per event: a list of objects with junk between, or text where a list should be."""
    item = F.col("props")
    body = (
        F.when(F.col("event_type") == "error", '"None Found"')
        .when(F.col("event_type") == "signup", "null")
        .otherwise(F.concat(F.lit("["), item, F.lit(', "junk", 7, '), item, F.lit("]")))
    )
    return t.events.select("event_id", F.regexp_replace(body, '^"(.*)"$', "$1").alias("body"))


@query(
    "envelope_unwrap",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
       FROM events, (VALUES (1), (2)) AS copies(n) WHERE event_type NOT IN ('error', 'signup')""",
)
def envelope_unwrap(t: Tables) -> DataFrame:
    return landing.unwrap(_envelopes(t), "k BIGINT")


@query(
    "overlapping_pages",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
)
def overlapping_pages(t: Tables) -> DataFrame:
    """Two pages that share their middle; merging by id leaves each order once."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    first = rows.where(F.col("o_orderstatus") != "P").withColumn("page", F.lit(1))
    second = rows.where(F.col("o_orderstatus") != "F").withColumn("page", F.lit(2))
    return merge.latest_per_key(first.unionByName(second), ["o_orderkey"], ["page"]).drop("page")


@query(
    "sheet_times",
    f"""SELECT event_id, CASE WHEN event_type <> 'error' THEN {time_sql('ts')} END AS "DateTime" FROM events""",
)
def sheet_times(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), _text("ts"))).otherwise(_text("ts"))
    return feeds.stock_ticks(t.events.select("event_id", text.alias("DateTime")))


@query(
    "distinct_value_list",
    """SELECT CAST(json_extract(props, '$.k') AS VARCHAR) AS k, count(*) AS uses FROM events
       WHERE event_type NOT IN ('error', 'signup') GROUP BY 1""",
)
def distinct_value_list(t: Tables) -> DataFrame:
    listed = F.concat(F.lit("["), "props", F.lit(', {"other": 1}]'))
    # some payloads have no object with the field
    body = F.when(F.col("event_type").isin("error", "signup"), F.lit('[{"other": 2}]')).otherwise(listed)
    payloads = t.events.select(body.alias("body"))
    return landing.value_list(payloads, "k").groupBy("k").agg(F.count(F.lit(1)).alias("uses"))


@query(
    "parallel_lists_to_rows",
    """SELECT vec_id, label, CAST(e AS DOUBLE) AS value, CAST(d AS DOUBLE) AS doubled
       FROM (SELECT vec_id, label, unnest(embedding) AS e, unnest([x * 2 for x in embedding]) AS d
             FROM embeddings)""",
)
def parallel_lists_to_rows(t: Tables) -> DataFrame:
    doubled = F.transform("embedding", lambda x: (x * F.lit(2).cast("float")).cast("float"))
    rows = landing.zip_lists(
        t.embeddings.withColumn("twice", doubled), {"value": "embedding", "doubled": "twice"}, "vec_id", "label"
    )
    return rows.withColumns({c: F.col(c).cast("double") for c in ("value", "doubled")})


@query(
    "child_table",
    """SELECT sha256(CAST(vec_id AS VARCHAR)) AS _dlt_root_id, generate_subscripts(embedding, 1) - 1 AS _dlt_list_idx,
       CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings""",
)
def child_table(t: Tables) -> DataFrame:
    rows = landing.child_table(landing.with_row_id(t.embeddings, ["vec_id"]), "embedding")
    return rows.withColumn("value", F.col("value").cast("double"))


@query(
    "flatten_structs",
    """SELECT c_custkey AS id, c_name AS who__name, c_mktsegment AS who__in__segment, c_nationkey AS who__in__nation
       FROM customer""",
)
def flatten_structs(t: Tables) -> DataFrame:
    nested = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("in"),
        ).alias("who"),
    )
    return landing.flatten_structs(nested)


@query("source_tag", "SELECT l_partkey, l_suppkey, 'lineitem' AS source_table FROM lineitem")
def source_tag(t: Tables) -> DataFrame:
    tagged = landing.tag_from_path(t.lineitem, r"/([^/]+)\.parquet$", "source_table")
    return tagged.select("l_partkey", "l_suppkey", "source_table")


@query(
    "list_of_structs",
    """SELECT source AS search_term, lang, count(*) AS books, sum(CASE WHEN lang <> 'fr' THEN 2 ELSE 0 END) AS authors
       FROM documents GROUP BY 1, 2""",
)
def list_of_structs(t: Tables) -> DataFrame:
    from lakeloom.workload.inputs import book_docs

    rows = feeds.books(book_docs(t)).select("search_term", F.col("ebook_access").alias("lang"), "authors")
    return rows.groupBy("search_term", "lang").agg(
        F.count(F.lit(1)).alias("books"), F.sum(F.size("authors")).alias("authors")
    )


@query(
    "work_ids",
    "SELECT 'OL' || doc_id AS work_id FROM documents WHERE lang <> 'de'",
)
def work_ids(t: Tables) -> DataFrame:
    from lakeloom.workload.inputs import book_docs

    return feeds.work_ids(feeds.books(book_docs(t)))


@query(
    "subjects_exploded",
    """SELECT work_id, count(*) AS subjects, min(subject) AS first_subject, max(subject) AS last_subject
       FROM (SELECT doc_id AS work_id, unnest(string_split(text, ' ')) AS subject FROM documents)
       WHERE subject <> '' GROUP BY work_id""",
)
def subjects_exploded(t: Tables) -> DataFrame:
    works = t.documents.select(F.col("doc_id").alias("work_id"), F.split("text", " ").alias("subjects"))
    return feeds.subjects(works).groupBy("work_id").agg(
        F.count(F.lit(1)).alias("subjects"),
        F.min("subject").alias("first_subject"),
        F.max("subject").alias("last_subject"),
    )


@query(
    "loaded_keys",
    """SELECT source AS search_term, CASE WHEN lang = 'de' THEN '/books/OL' ELSE '/works/OL' END || doc_id AS key
       FROM documents WHERE source IN ('src0', 'src7')""",
)
def loaded_keys(t: Tables) -> DataFrame:
    from lakeloom.workload.inputs import book_docs

    return feeds.loaded_keys(feeds.books(book_docs(t)), ["src0", "src7"])


@query(
    "detail_enrichment",
    """SELECT c_custkey AS city_id, c_name AS city, c_acctbal AS latitude, c_acctbal AS longitude,
       CASE WHEN n_regionkey > 1 THEN n_name ELSE 'from city' END AS country, c_mktsegment AS country_code,
       n_name AS region, CAST(n_regionkey AS VARCHAR) AS region_code, 'OC' AS continent
       FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def detail_enrichment(t: Tables) -> DataFrame:
    cities = t.customer.select(
        F.col("c_custkey").alias("geonameId"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("lat"),
        F.col("c_acctbal").alias("lng"),
        F.lit("from city").alias("countryName"),
        F.col("c_mktsegment").alias("country_code"),
    )
    named = F.when(F.col("n_regionkey") > 1, F.col("n_name")).when(F.col("n_regionkey") == 1, "")
    placed = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    details = placed.select(
        F.col("c_custkey").alias("geonameId"),
        named.alias("countryName"),
        F.col("n_name").alias("adminName1"),
        _text("n_regionkey").alias("adminCode1"),
        F.lit("OC").alias("continentCode"),
    )
    return feeds.cities_with_details(cities, details)


def _activity_items(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "upload").when(
        F.col("event_type") == "click", "addToPlaylist"
    ).otherwise(F.col("event_type"))
    return t.events.select(
        _text("event_id").alias("id"),
        F.struct(
            F.concat(F.lit("title "), _text("event_id")).alias("title"),
            F.col("props").alias("description"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            kind.alias("type"),
        ).alias("snippet"),
        F.struct(
            F.struct(F.concat(F.lit("v"), _text("user_id")).alias("videoId")).alias("upload"),
            F.struct(F.concat(F.lit("p"), _text("user_id")).alias("playlistId")).alias("addToPlaylist"),
            F.concat(F.lit("v"), _text("event_id")).alias("videoId"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("videoPublishedAt"),
            F.lit("PT1M").alias("duration"),
            F.col("user_id").alias("itemCount"),
            F.struct(F.concat(F.lit("u"), _text("user_id")).alias("uploads")).alias("relatedPlaylists"),
        ).alias("contentDetails"),
        F.struct(
            _text("user_id").alias("subscriberCount"),
            _text("user_id").alias("videoCount"),
            F.when(F.col("event_type") != "error", _text("user_id")).alias("viewCount"),
            _text("user_id").alias("likeCount"),
            F.lit(None).cast("string").alias("commentCount"),
        ).alias("statistics"),
        F.concat(F.lit("c"), _text("user_id")).alias("channel_id"),
    )


_PUBLISHED_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"


@query(
    "channel_projection",
    f"""SELECT CAST(event_id AS VARCHAR) AS id, 'title ' || event_id AS title, props AS description,
        {_PUBLISHED_SQL} AS published_at, CAST(user_id AS VARCHAR) AS subscriber_count,
        CAST(user_id AS VARCHAR) AS video_count,
        CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS view_count,
        'u' || user_id AS uploads_playlist_id FROM events""",
)
def channel_projection(t: Tables) -> DataFrame:
    return feeds.channels(_activity_items(t))


@query(
    "video_projection",
    f"""SELECT 'v' || event_id AS id, {_PUBLISHED_SQL} AS published_at, 'title ' || event_id AS title,
        props AS description, 'PT1M' AS duration, CAST(user_id AS VARCHAR) AS like_count,
        CAST(NULL AS VARCHAR) AS comment_count,
        CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS view_count, 'c' || user_id AS channel_id
        FROM events WHERE {_PUBLISHED_SQL} > '2024-01-10T00:00:00Z'""",
)
def video_projection(t: Tables) -> DataFrame:
    return feeds.videos(_activity_items(t), "2024-01-10T00:00:00Z")


@query(
    "playlist_projection",
    f"""SELECT CAST(event_id AS VARCHAR) AS id, 'title ' || event_id AS title, props AS description,
        {_PUBLISHED_SQL} AS published_at, user_id AS item_count, 'c' || user_id AS channel_id FROM events""",
)
def playlist_projection(t: Tables) -> DataFrame:
    return feeds.playlists(_activity_items(t))


@query(
    "activity_projection",
    f"""SELECT CAST(event_id AS VARCHAR) AS id, 'title ' || event_id AS title,
        CASE event_type WHEN 'view' THEN 'upload' WHEN 'click' THEN 'addToPlaylist' ELSE event_type END AS type,
        CASE event_type WHEN 'view' THEN 'v' || user_id END AS video_id, props AS description,
        CASE event_type WHEN 'click' THEN 'p' || user_id END AS playlist_id,
        {_PUBLISHED_SQL} AS published_at, 'c' || user_id AS channel_id
        FROM events WHERE {_PUBLISHED_SQL} > '2024-01-10T00:00:00Z'""",
)
def activity_projection(t: Tables) -> DataFrame:
    return feeds.activities(_activity_items(t), "2024-01-10T00:00:00Z")


@query(
    "draws_kept_as_bag",
    """SELECT o_custkey AS id, o_orderpriority AS tag, CAST(NULL AS VARCHAR) AS extra FROM orders
       UNION ALL SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders""",
)
def draws_kept_as_bag(t: Tables) -> DataFrame:
    draw = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("tag"), "o_orderstatus")
    return draw.drop("o_orderstatus").unionByName(
        draw.withColumnRenamed("o_orderstatus", "extra"), allowMissingColumns=True
    )


# ================================================================ columns


@query(
    "surrogate_keys",
    f"""SELECT DISTINCT n_name, r_name, {key_sql('n_name', 'r_name')} AS city_sk, {key_sql('r_name')} AS country_sk
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT * FROM region WHERE r_regionkey > 0) ON r_regionkey = n_regionkey""",
)
def surrogate_keys(t: Tables) -> DataFrame:
    used = t.customer.select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    # the first region lands without its key, so its nations find no match
    key = F.col("r_regionkey")
    some = t.region.select(F.when(key > 0, key).alias("n_regionkey"), *[c for c in t.region.columns if c != "r_regionkey"])
    places = t.nation.join(used, "n_nationkey").join(some, "n_regionkey", "left")
    keyed = places.select(
        "n_name",
        "r_name",
        C.surrogate_key("n_name", "r_name").alias("city_sk"),
        C.surrogate_key("r_name").alias("country_sk"),
    )
    return dims.dimension(keyed, *keyed.columns)


@query(
    "null_markers",
    r"""SELECT c_custkey, nullif(blank, '') AS blank, nullif(marked, '\N') AS marked,
        nullif(trim(replace(spaced, '\n', '')), '') AS spaced
        FROM (SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN '' ELSE c_name END AS blank,
                     CASE WHEN c_acctbal < 2000 THEN '\N' WHEN c_acctbal < 3000 THEN '\n' ELSE c_name END AS marked,
                     CASE WHEN c_acctbal < 4000 THEN ' \n ' WHEN c_acctbal < 5000 THEN '\N' ELSE ' x\n' END AS spaced
              FROM customer)""",
)
def null_markers(t: Tables) -> DataFrame:
    b = F.col("c_acctbal")
    raw = t.customer.select(
        "c_custkey",
        F.when(b < 1000, "").otherwise(F.col("c_name")).alias("blank"),
        F.when(b < 2000, "\\N").when(b < 3000, "\\n").otherwise(F.col("c_name")).alias("marked"),
        F.when(b < 4000, " \\n ").when(b < 5000, "\\N").otherwise(" x\\n").alias("spaced"),
    )
    return raw.select(
        "c_custkey",
        C.blank_to_null("blank").alias("blank"),
        C.null_marker("marked").alias("marked"),
        C.clean_text("spaced").alias("spaced"),
    )


@query(
    "id_from_path",
    """SELECT l_orderkey, CAST(l_partkey AS INTEGER) AS part_id, CAST(l_suppkey AS VARCHAR) AS last_part
       FROM lineitem""",
)
def id_from_path(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        C.trailing_id(F.concat(F.lit("https://x/12/"), _text("l_partkey"))).alias("part_id"),
        C.last_segment(F.concat(F.lit("/works/"), _text("l_suppkey"))).alias("last_part"),
    )


@query(
    "url_last_segment",
    "SELECT page_id, string_split(url, '/')[-1] AS segment FROM pages",
)
def url_last_segment(t: Tables) -> DataFrame:
    return t.pages.select("page_id", C.last_segment("url").alias("segment"))


@query(
    "codes_and_long_dates",
    """SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS read_back FROM orders""",
)
def codes_and_long_dates(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        C.code_number("o_orderpriority", 1, 1).alias("level"),
        C.long_date(F.date_format("o_orderdate", "MMMM dd, yyyy")).alias("read_back"),
    )


@query(
    "zone_shifts",
    f"""SELECT event_id,
        {time_sql("ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Melbourne'")} AS local,
        {time_sql("ts AT TIME ZONE 'Australia/Melbourne' AT TIME ZONE 'UTC'")} AS reinterpreted,
        {day_sql("ts AT TIME ZONE 'Australia/Melbourne' AT TIME ZONE 'UTC'")} AS utc_day,
        {day_sql("CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE) - 2")} AS two_days_before
        FROM events""",
)
def zone_shifts(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        C.to_local("ts").alias("local"),
        C.reinterpret_utc_as(F.col("ts").cast("timestamp")).alias("reinterpreted"),
        C.utc_date_of_local_text(_text("ts")).alias("utc_day"),
        C.local_day_before("ts", 2).alias("two_days_before"),
    )


@query(
    "market_hours",
    """SELECT event_id, value FROM (SELECT *, ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS local FROM events)
       WHERE isodow(local) < 6 AND CAST(local AS TIME) BETWEEN TIME '10:00:00' AND TIME '16:00:00'""",
)
def market_hours(t: Tables) -> DataFrame:
    return t.events.where(C.in_market_hours("ts")).select("event_id", "value")


@query(
    "safe_names",
    r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '\s+', '', 'g'),
        '[^\x00-\x7F]', '', 'g'), '[^A-Za-z0-9_.\-]', '_', 'g')) AS safe FROM documents""",
)
def safe_names(t: Tables) -> DataFrame:
    """Whole texts; shown as a digest to keep the result narrow."""
    return t.documents.select("doc_id", F.md5(C.safe_name("text")).alias("safe"))


@query(
    "iso_texts",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text, CAST(o_custkey AS VARCHAR) AS key_text
       FROM orders""",
)
def iso_texts(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", C.iso_text("o_orderdate", True).alias("day_text"), C.iso_text("o_custkey", False).alias("key_text")
    )


# ================================================================ joins, dimensions, permutations


@query(
    "grouped_counts_join",
    """SELECT c_custkey, c_name, n_urgent
       FROM customer LEFT JOIN (SELECT o_custkey, count(CASE o_orderpriority WHEN '1-URGENT' THEN 1 END) AS n_urgent
                                FROM orders GROUP BY 1)
            ON o_custkey = c_custkey""",
)
def grouped_counts_join(t: Tables) -> DataFrame:
    children = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderpriority") == "1-URGENT", True).alias("urgent")
    )
    parents = t.customer.select("c_custkey", "c_name")
    return joins.attach_counts(parents, children, "c_custkey", "urgent", "n_urgent")


@query(
    "lookup_fans_out",
    """SELECT c_custkey, c_nationkey, segment
       FROM customer LEFT JOIN (SELECT DISTINCT CASE WHEN c_acctbal > 9000 THEN c_nationkey ELSE -1 - c_nationkey END AS nation,
                                       c_mktsegment AS segment FROM customer) ON nation = c_nationkey""",
)
def lookup_fans_out(t: Tables) -> DataFrame:
    """A lookup with several rows per key, at most one for each of the market segments."""
    rich = F.when(F.col("c_acctbal") > 9000, F.col("c_nationkey")).otherwise(-1 - F.col("c_nationkey"))
    table = t.customer.select(rich.alias("c_nationkey"), F.col("c_mktsegment").alias("segment"))
    return joins.lookup(t.customer.select("c_custkey", "c_nationkey"), table.distinct(), "c_nationkey")


@query("distinct_bridge", "SELECT DISTINCT l_partkey AS part_id FROM lineitem WHERE l_partkey IS NOT NULL")
def distinct_bridge(t: Tables) -> DataFrame:
    return dims.key_bridge(t.lineitem, "l_partkey", "part_id")


@query(
    "flag_selections",
    """WITH flags AS (SELECT DISTINCT l_orderkey, l_returnflag AS flag FROM lineitem)
       SELECT a.l_orderkey, a.flag AS flag1, b.flag AS flag2, c.flag AS flag3
       FROM flags a LEFT JOIN flags b ON b.l_orderkey = a.l_orderkey AND b.flag <> a.flag
       LEFT JOIN flags c ON c.l_orderkey = a.l_orderkey AND c.flag NOT IN (a.flag, b.flag)""",
)
def flag_selections(t: Tables) -> DataFrame:
    """Ordered selections of the return flags of an order; an order has at most three of them."""
    flags = t.lineitem.select("l_orderkey", "l_returnflag").distinct()
    return permute.ordered_selections(flags, "l_orderkey", "l_returnflag", ["flag1", "flag2", "flag3"])


@query(
    "calendar_of_orders",
    """SELECT weekday_name, is_weekend, quarter, count(*) AS days, sum(n) AS orders
       FROM order_calendar LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS placed, count(*) AS n FROM orders GROUP BY 1)
            ON placed = date_col
       GROUP BY 1, 2, 3""",
)
def calendar_of_orders(t: Tables) -> DataFrame:
    from lakeloom.workload.models import order_calendar

    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("date_col")).agg(F.count(F.lit(1)).alias("n"))
    return (
        joins.lookup(order_calendar(t), per_day, "date_col")
        .groupBy("weekday_name", "is_weekend", "quarter")
        .agg(F.count(F.lit(1)).alias("days"), F.sum("n").alias("orders"))
    )


# ================================================================ windows


@query(
    "rolling_anomaly",
    f"""SELECT event_type, {day_sql('day')} AS day, {six_sql('total')} AS total,
        {six_sql('total - avg(total) OVER f')} AS anomaly, {six_sql('avg(total) OVER f')} AS trailing_avg,
        {six_sql('total - lag(total) OVER d')} AS change
        FROM (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS total FROM events GROUP BY 1, 2)
        WINDOW d AS (PARTITION BY event_type ORDER BY day),
               f AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
)
def rolling_anomaly(t: Tables) -> DataFrame:
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("total"))

    def measures(frame, ordered):
        total = F.col("total")
        return {
            "anomaly": total - F.avg(total).over(frame),
            "trailing_avg": F.avg(total).over(frame),
            "change": total - F.lag(total).over(ordered),
        }

    rows = windows.trailing(
        settle(daily, "daily-events"),
        ["event_type"],
        ["day"],
        measures,
        V.TRAILING_ROWS,
    )
    return rows.withColumns({c: six(F.col(c)) for c in ("total", "anomaly", "trailing_avg", "change")})


@query(
    "rolling_ticks",
    f"""SELECT event_id, event_type, {six_sql('avg(value) OVER f')} AS trailing_avg,
        {six_sql('value - lag(value) OVER d')} AS change FROM events
        WINDOW d AS (PARTITION BY event_type ORDER BY ts, event_id),
               f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
)
def rolling_ticks(t: Tables) -> DataFrame:
    """Single ticks of five types, so each type holds a large share and is worked on in slices."""

    def measures(frame, ordered):
        value = F.col("value")
        return {"trailing_avg": F.avg(value).over(frame), "change": value - F.lag(value).over(ordered)}

    ticks = t.events.select("event_id", "event_type", "ts", "value")
    rows = windows.trailing(
        ticks,
        ["event_type"],
        ["ts", "event_id"],
        measures,
        V.TRAILING_ROWS,
    )
    return rows.select("event_id", "event_type", six(F.col("trailing_avg")).alias("trailing_avg"), six(F.col("change")).alias("change"))


@query(
    "rolling_late_ticks",
    f"""SELECT event_id, event_type, {six_sql('avg(value) OVER f')} AS trailing_avg,
        {six_sql('value - lag(value) OVER d')} AS change FROM events
        WINDOW d AS (PARTITION BY event_type ORDER BY ts, event_id),
               f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
)
def rolling_late_ticks(t: Tables) -> DataFrame:
    """The same measures kept on disk: the ticks of one type of each hundred users come late and replace their frames."""

    def measures(frame, ordered):
        value = F.col("value")
        return {"trailing_avg": six(F.avg(value).over(frame)), "change": six(value - F.lag(value).over(ordered))}

    ticks = t.events.select("event_id", "user_id", "event_type", "ts", "value")
    is_late = (F.col("user_id") % 100 == 7) & (F.col("event_type") == "view")
    path = scratch_path(t.spark, "ticks-measured")
    for some in (ticks.where(~is_late), ticks.where(is_late)):
        rows = some.drop("user_id")
        slot = F.date_diff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
        refresh.refresh_trailing(rows, path, ["event_type"], ["ts", "event_id"], measures, V.TRAILING_ROWS, slot)
    return refresh.read_trailing(t.spark, path).select("event_id", "event_type", "trailing_avg", "change")


@query(
    "price_movement",
    """SELECT event_id, stock, CAST(round(CAST(high - low AS DECIMAL(38,10)), 2) AS DOUBLE) AS price_spread,
       CAST(round(CAST(price - opened AS DECIMAL(38,10)), 2) AS DOUBLE) AS relative_price_movement,
       CAST(round(CAST(closed - opened AS DECIMAL(38,10)), 2) AS DOUBLE) AS abs_price_movement,
       entries AS num_stock_entries
       FROM (SELECT event_id, event_type AS stock, value AS price, max(value) OVER s AS high, min(value) OVER s AS low,
                    count(event_id) OVER s AS entries, first(value) OVER w AS opened, last(value) OVER w AS closed
             FROM events
             WINDOW s AS (PARTITION BY event_type),
                    w AS (PARTITION BY event_type ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""",
)
def price_movement(t: Tables) -> DataFrame:
    ticks = t.events.select("event_id", F.col("event_type").alias("stock"), F.col("value").alias("price"), "ts")
    return windows.price_movement(ticks, "stock", "price", "ts", "event_id").drop("price", "ts")


# ================================================================ load dispositions


def _stored_and_updates(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders up to 1997 per customer and day, and later loads that raise some prices again."""
    cols = [
        F.col("o_custkey").alias("cust"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("seq"),
    ]
    stored = merge.latest_per_key(
        t.orders.where(F.col("o_orderdate") < _at("1998-01-01")).select(*cols), ["cust", "day"], ["seq"]
    )
    updates = t.orders.where(F.col("o_orderdate") >= _at("1997-01-01")).select(*cols)
    return stored, updates.withColumn("price", F.col("price") + 1)


@query(
    "merge_by_key",
    f"""SELECT cust, {day_sql('day')} AS day, price, seq
        FROM (SELECT *, row_number() OVER (PARTITION BY cust, day ORDER BY load DESC, seq DESC) AS r
              FROM (SELECT 1 AS load, o_custkey AS cust, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price,
                           o_orderkey AS seq FROM orders WHERE year(o_orderdate) < 1998
                    UNION ALL
                    SELECT 2, o_custkey, CAST(o_orderdate AS DATE), o_totalprice + 1, o_orderkey FROM orders
                    WHERE year(o_orderdate) >= 1997))
        WHERE r = 1""",
)
def merge_by_key(t: Tables) -> DataFrame:
    stored, updates = _stored_and_updates(t)
    return merge.merge_by_key(stored, updates, ["cust", "day"], ["seq"])


@query(
    "merge_into_partitions",
    """SELECT year, cust, price, seq
       FROM (SELECT *, row_number() OVER (PARTITION BY cust, year ORDER BY load DESC, seq DESC) AS r
             FROM (SELECT 1 AS load, year(o_orderdate) AS year, o_custkey AS cust, o_totalprice AS price,
                          o_orderkey AS seq FROM orders WHERE year(o_orderdate) < 1998
                   UNION ALL
                   SELECT 2, year(o_orderdate), o_custkey, o_totalprice + 1, o_orderkey FROM orders
                   WHERE year(o_orderdate) >= 1997))
       WHERE r = 1""",
)
def merge_into_partitions(t: Tables) -> DataFrame:
    """Two loads into a table on disk; the second rewrites only the years it touches."""
    path = scratch_path(t.spark, "orders-by-year")
    rows = t.orders.select(
        F.year("o_orderdate").alias("year"),
        F.col("o_custkey").alias("cust"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("seq"),
    )
    newest = ["seq"]
    merge.upsert_table(rows.where("year < 1998"), path, ["cust", "year"], newest, ["year"])
    raised = rows.where("year >= 1997").withColumn("price", F.col("price") + 1)
    merge.upsert_table(raised, path, ["cust", "year"], newest, ["year"])
    return t.spark.read.parquet(path)


@query(
    "merge_into_buckets",
    f"""SELECT cust, {day_sql('day')} AS day, price, seq
        FROM (SELECT *, row_number() OVER (PARTITION BY cust, day ORDER BY load DESC, seq DESC) AS r
              FROM (SELECT 1 AS load, o_custkey AS cust, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price,
                           o_orderkey AS seq FROM orders WHERE year(o_orderdate) < 1998
                    UNION ALL
                    SELECT 2, o_custkey, CAST(o_orderdate AS DATE), o_totalprice + 1, o_orderkey FROM orders
                    WHERE year(o_orderdate) >= 1997))
        WHERE r = 1""",
)
def merge_into_buckets(t: Tables) -> DataFrame:
    """Two loads into a table of hash buckets; readers see its versions."""
    path = scratch_path(t.spark, "orders-in-buckets")
    stored, updates = _stored_and_updates(t)
    for load in (stored, updates):
        versioned.merge_table(load, path, ["cust", "day"], ["seq"], buckets=8)
    return versioned.read_table(t.spark, path)


@query(
    "incremental_append",
    f"""SELECT o_orderkey, o_totalprice, {day_sql('o_orderdate')} AS day FROM orders WHERE o_orderstatus <> 'F'""",
)
def incremental_append(t: Tables) -> DataFrame:
    """The rows a run adds to a table that already holds the finished orders."""
    stored = t.orders.where(F.col("o_orderstatus") == "F")
    fresh = merge.new_rows(stored, t.orders, ["o_orderkey"])
    return fresh.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))


@query(
    "append_by_presence",
    """SELECT o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'all' END AS batch FROM orders""",
)
def append_by_presence(t: Tables) -> DataFrame:
    """Two batches into an indexed table: the finished orders, then all orders again."""
    path = scratch_path(t.spark, "orders-by-batch")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    presence.append_indexed(rows.where("o_orderstatus = 'F'"), path, "finished", ["o_orderkey"])
    presence.append_indexed(rows, path, "all", ["o_orderkey"])
    return presence.read_batches(t.spark, path).drop("o_orderstatus")


def _measured_sql(batch: int) -> str:
    return f"""SELECT event_id, {batch} AS batch, CAST(round(CAST(high - low AS DECIMAL(38,10)), 2) AS DOUBLE) AS price_spread,
       CAST(round(CAST(price - opened AS DECIMAL(38,10)), 2) AS DOUBLE) AS relative_price_movement,
       CAST(round(CAST(closed - opened AS DECIMAL(38,10)), 2) AS DOUBLE) AS abs_price_movement,
       entries AS num_stock_entries
       FROM (SELECT event_id, value AS price, max(value) OVER s AS high, min(value) OVER s AS low,
                    count(event_id) OVER s AS entries, first(value) OVER w AS opened, last(value) OVER w AS closed
             FROM events WHERE event_id % 3 <= {batch}
             WINDOW s AS (PARTITION BY event_type),
                    w AS (PARTITION BY event_type ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
       WHERE event_id % 3 = {batch}"""


@query("prices_by_batch", " UNION ALL ".join(f"({_measured_sql(b)})" for b in range(3)))
def prices_by_batch(t: Tables) -> DataFrame:
    """Ticks in three loads whose times mix, each measured over all ticks loaded so far."""
    path = scratch_path(t.spark, "ticks-by-batch")
    ticks = t.events.select("event_id", F.col("event_type").alias("stock"), F.col("value").alias("price"), "ts")
    loads = []
    for batch in range(3):
        some = ticks.where(F.col("event_id") % 3 == batch)
        found = summaries.append_measured(some, path, str(batch), "stock", "price", "ts", "event_id", fold_at=2)
        loads.append(found.select("event_id", F.lit(batch).alias("batch"), *found.columns[4:]))
    return loads[0].unionByName(loads[1]).unionByName(loads[2])


@query("append_table", "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders")
def append_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "appended")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    merge.replace_table(rows, path)
    merge.append_table(rows, path)
    return t.spark.read.parquet(path)


@query("publish_version", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def publish_version(t: Tables) -> DataFrame:
    contract = T.StructType(
        [
            T.StructField("s_suppkey", T.LongType()),
            T.StructField("s_name", T.StringType()),
            T.StructField("s_acctbal", T.DoubleType()),
        ]
    )
    rows = sink.require_rows(t.supplier.select(*contract.names), "supplier")
    sink.publish(rows, scratch_path(t.spark, "warehouse"), "base", "suppliers", "1", contract)
    return sink.published(t.spark, "base", "suppliers")


@query("publish_sorted", "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem")
def publish_sorted(t: Tables) -> DataFrame:
    """A table whose files are sorted by two columns and partitioned by a third."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    root = scratch_path(t.spark, "warehouse")
    by, order = ("l_returnflag",), ("l_orderkey", "l_linenumber")
    return sink.publish(rows, root, "common", "shipped", "1", partition_by=by, sort_by=order)


@query(
    "listed_balances",
    """SELECT s_nationkey, s_acctbal, s_suppkey FROM supplier
       ORDER BY s_nationkey DESC NULLS LAST, s_acctbal DESC NULLS LAST, s_suppkey DESC NULLS LAST LIMIT 40""",
)
def listed_balances(t: Tables) -> DataFrame:
    """The first 40 rows of a table read as a list, in descending order of three columns."""
    rows = t.supplier.select("s_nationkey", "s_acctbal", "s_suppkey")
    return sink.listed(rows, "s_nationkey", "s_acctbal", "s_suppkey").limit(40)


_STAMPED = {"1-URGENT": "Sydney", "2-HIGH": "Perth", "3-MEDIUM": "Darwin", "4-NOT SPECIFIED": "Wellington"}


@query(
    "stamps_of_places",
    """WITH stamped AS (SELECT o_orderkey, city, o_orderdate AS placed, o_orderdate AT TIME ZONE 'UTC' AT TIME ZONE zone AS here
           FROM orders JOIN (VALUES ('1-URGENT', 'Sydney', 'Australia/Sydney'), ('2-HIGH', 'Perth', 'Australia/Perth'),
               ('3-MEDIUM', 'Darwin', 'Australia/Darwin'), ('4-NOT SPECIFIED', 'Wellington', 'Pacific/Auckland')) AS z(priority, city, zone)
           ON o_orderpriority = priority)
       SELECT o_orderkey, city, strftime(here, '%Y-%m-%dT%H:%M:%S') || '+' || lpad(CAST(date_diff('minute', placed, here) // 60 AS VARCHAR), 2, '0')
           || ':' || lpad(CAST(date_diff('minute', placed, here) % 60 AS VARCHAR), 2, '0') AS stamp
       FROM stamped
       UNION ALL SELECT o_orderkey, 'Nowhere', NULL FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def stamps_of_places(t: Tables) -> DataFrame:
    """The date of each order as the clock of a configured place shows it; a place that is not configured has none."""
    named = F.lit("Nowhere")
    for priority, city in _STAMPED.items():
        named = F.when(F.col("o_orderpriority") == priority, city).otherwise(named)
    rows = t.orders.select("o_orderkey", named.alias("city"), "o_orderdate")
    return rows.select("o_orderkey", "city", feeds.stamp_of_place("o_orderdate").alias("stamp"))


@query("publish_current", "SELECT s_suppkey, upper(s_name) AS s_name FROM supplier")
def publish_current(t: Tables) -> DataFrame:
    """Two versions of a table, read back by its name from the folder, as another session would."""
    root = scratch_path(t.spark, "warehouse")
    rows = t.supplier.select("s_suppkey", "s_name")
    checks = [quality.NotNull("s_suppkey"), quality.Unique("s_suppkey")]
    for version, df in (("1", rows), ("2", rows.withColumn("s_name", F.upper("s_name")))):
        sink.publish(df, root, "base", "named_suppliers", version, checks=checks)
    return sink.read_current(t.spark, root, "base", "named_suppliers")


@query("published_view", "SELECT n_nationkey, n_name FROM nation")
def published_view(t: Tables) -> DataFrame:
    sink.publish_view(t.nation.select("n_nationkey", "n_name"), "staging", "nations")
    return sink.published(t.spark, "staging", "nations")


# ================================================================ history


RUN_DAYS = ("1996-09-01", "1998-05-01", "2000-01-01", "2002-01-01")


def _segment_states(t: Tables) -> list[tuple[str, DataFrame]]:
    """Priority of the last order of each customer with an order since the run before; all orders belong to a run."""
    states = []
    for since, until in zip(("1900-01-01", *RUN_DAYS), RUN_DAYS):
        span = t.orders.where((F.col("o_orderdate") < _at(until)) & (F.col("o_orderdate") >= _at(since)))
        last = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
        states.append((f"{until} 00:00:00", span.groupBy("o_custkey").agg(last.alias("priority"))))
    return states


piece(
    "priority_states",
    """SELECT o_custkey, run, run_at, max(o_orderpriority) FILTER (r = 1) AS priority
       FROM (SELECT o_custkey, run, run_at, CASE WHEN inside THEN o_orderpriority END AS o_orderpriority,
                    row_number() OVER (PARTITION BY o_custkey, run ORDER BY inside DESC, o_orderdate DESC, o_orderkey DESC) AS r
             FROM (SELECT *, o_orderdate < run_at AND o_orderdate >= since AS inside
                   FROM orders, (VALUES (1, TIMESTAMP '1900-01-01', TIMESTAMP '1996-09-01'),
                                        (2, TIMESTAMP '1996-09-01', TIMESTAMP '1998-05-01'),
                                        (3, TIMESTAMP '1998-05-01', TIMESTAMP '2000-01-01'),
                                        (4, TIMESTAMP '2000-01-01', TIMESTAMP '2002-01-01')) AS runs(run, since, run_at)))
       GROUP BY 1, 2, 3""",
)
piece(
    "priority_history",
    """SELECT o_custkey, priority, run_at AS dbt_valid_from,
       (SELECT min(later.run_at) FROM priority_states later
        WHERE later.o_custkey = s.o_custkey AND later.run > s.run
          AND later.priority IS DISTINCT FROM s.priority) AS dbt_valid_to
       FROM (SELECT *, lag(priority) OVER (PARTITION BY o_custkey ORDER BY run) AS before FROM priority_states) s
       WHERE priority IS NOT NULL AND before IS DISTINCT FROM priority""",
)


def _priority_history(t: Tables) -> DataFrame:
    past = None
    for run_at, state in _segment_states(t):
        past = settle(history.snapshot(past, state, "o_custkey", ["priority"], run_at), "priority-history")
    return past


@query(
    "scd2_snapshot",
    f"""SELECT o_custkey, priority, {time_sql('dbt_valid_from')} AS dbt_valid_from,
        {time_sql('dbt_valid_to')} AS dbt_valid_to FROM priority_history""",
)
def scd2_snapshot(t: Tables) -> DataFrame:
    """Four runs in which customers appear, change, vanish and come back."""
    return _priority_history(t).select("o_custkey", "priority", "dbt_valid_from", "dbt_valid_to")


@query(
    "scd2_table",
    f"""SELECT o_custkey, priority, {time_sql('dbt_valid_from')} AS dbt_valid_from,
        {time_sql('dbt_valid_to')} AS dbt_valid_to FROM priority_history""",
)
def scd2_table(t: Tables) -> DataFrame:
    """The same runs on a history on disk, where closed rows are not touched again."""
    path = scratch_path(t.spark, "history")
    for run_at, state in _segment_states(t):
        history.snapshot_table(state, path, "o_custkey", ["priority"], run_at)
    rows = history.read_history(t.spark, path)
    return rows.select("o_custkey", "priority", "dbt_valid_from", "dbt_valid_to")


@query(
    "scd2_changes",
    f"""SELECT o_custkey, priority, {time_sql('dbt_valid_from')} AS dbt_valid_from,
        {time_sql('dbt_valid_to')} AS dbt_valid_to FROM priority_history""",
)
def scd2_changes(t: Tables) -> DataFrame:
    """The same runs on a history of a base and changes, folded on the way."""
    path = scratch_path(t.spark, "history-changes")
    for run_at, state in _segment_states(t):
        changes.snapshot_changes(state, path, "o_custkey", ["priority"], run_at, fold_every=2)
    return changes.read_changes(t.spark, path).select("o_custkey", "priority", "dbt_valid_from", "dbt_valid_to")


@query(
    "current_row_join",
    """SELECT o_orderkey, o.o_custkey, priority AS current_priority
       FROM orders o LEFT JOIN (SELECT * FROM priority_history WHERE dbt_valid_to IS NULL) h ON h.o_custkey = o.o_custkey""",
)
def current_row_join(t: Tables) -> DataFrame:
    current = history.current_rows(_priority_history(t)).select("o_custkey", F.col("priority").alias("current_priority"))
    return joins.lookup(t.orders.select("o_orderkey", "o_custkey"), current, "o_custkey")


# ================================================================ planning


@query(
    "counts_per_key",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1",
)
def counts_per_key(t: Tables) -> DataFrame:
    return planning.count_per_key(t.orders, "o_custkey")


@query(
    "counts_per_table",
    """SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'documents', count(*) FROM documents""",
)
def counts_per_table(t: Tables) -> DataFrame:
    return planning.counts_per_table({"orders": t.orders, "lineitem": t.lineitem, "documents": t.documents})


piece(
    "gate_counts",
    """SELECT c_nationkey AS nation, incoming, coalesce(stored, 0) AS stored, coalesce(previous, 0) AS previous
       FROM (SELECT c_nationkey, count(*) AS incoming FROM customer GROUP BY 1)
       LEFT JOIN (SELECT c_nationkey, count(*) AS stored FROM customer
                  WHERE c_acctbal > 0 OR c_nationkey < 9 GROUP BY 1) USING (c_nationkey)
       LEFT JOIN (SELECT c_nationkey, count(*) AS previous FROM customer
                  WHERE c_nationkey BETWEEN 3 AND 20 AND (c_nationkey < 12 OR c_acctbal > 500) GROUP BY 1)
            USING (c_nationkey)""",
)


def _gate_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of the feed, of what is stored and of the state; rows that have not been stored yet count under no nation."""
    n, b = F.col("c_nationkey"), F.col("c_acctbal")

    def counted(known: Column, alias: str) -> DataFrame:
        rows = t.customer.select(F.when(known, n).alias("nation"))
        return planning.count_per_key(rows, "nation", alias).where("nation is not null")

    return (
        counted(F.lit(True), "incoming"),
        counted((b > 0) | (n < 9), "stored"),
        counted(n.between(3, 20) & ((n < 12) | (b > 500)), "previous"),
    )


def _gate_sql(action: str, extra: str = "") -> str:
    return f"""SELECT *, CASE WHEN action = 'skip' THEN previous ELSE incoming END AS next_previous {extra}
               FROM (SELECT *, {action} AS action FROM gate_counts)"""


@query(
    "reload_gate",
    _gate_sql(
        """CASE WHEN stored < previous OR stored = 0 THEN 'reload' WHEN incoming = previous THEN 'skip'
           ELSE 'load' END"""
    ),
)
def reload_gate(t: Tables) -> DataFrame:
    return planning.reload_gate(*_gate_tables(t), "nation")


@query(
    "count_gate",
    _gate_sql("CASE WHEN stored < previous THEN 'reload' WHEN incoming = previous THEN 'skip' ELSE 'load' END"),
)
def count_gate(t: Tables) -> DataFrame:
    return planning.count_gate(*_gate_tables(t), "nation")


@query(
    "growth_gate",
    _gate_sql(
        """CASE WHEN previous < incoming THEN 'load' WHEN stored > 0 AND incoming = previous THEN 'skip'
           ELSE 'load' END""",
        ", CAST(ceil(incoming / 100) AS BIGINT) AS pages",
    ),
)
def growth_gate(t: Tables) -> DataFrame:
    return planning.growth_gate(*_gate_tables(t), "nation")


@query(
    "gate_state",
    """SELECT coalesce(g.nation, s.nation) AS nation,
       CASE WHEN g.nation IS NULL THEN s.previous WHEN incoming = g.previous AND stored >= g.previous AND stored > 0
            THEN g.previous ELSE incoming END AS previous
       FROM gate_counts g FULL JOIN (SELECT c_nationkey AS nation, count(*) AS previous FROM customer
            WHERE c_nationkey BETWEEN 3 AND 20 AND (c_nationkey < 12 OR c_acctbal > 500) GROUP BY 1) s
            ON s.nation = g.nation""",
)
def gate_state(t: Tables) -> DataFrame:
    incoming, stored, state = _gate_tables(t)
    return planning.advance_state(state, planning.reload_gate(incoming, stored, state, "nation"), "nation")


piece(
    "order_span",
    """SELECT CASE o_orderstatus WHEN 'P' THEN -1 - o_custkey ELSE o_custkey END AS cust,
       min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date FROM orders GROUP BY 1""",
)
piece(
    "order_ranges",
    """SELECT c_custkey AS cust,
       CASE WHEN max_date IS NULL THEN DATE '1995-03-01' ELSE greatest(max_date + 1, DATE '1995-03-01') END AS start_date,
       DATE '2001-06-30' AS end_date,
       CASE WHEN max_date - min_date + 1 >= DATE '2001-06-30' - DATE '1995-03-01' + 1 AND max_date >= DATE '2001-06-30'
            THEN 'skipped'
            WHEN max_date IS NOT NULL AND max_date + 1 > DATE '2001-06-30' THEN 'skipped' ELSE 'fetch' END AS status
       FROM customer LEFT JOIN order_span ON cust = c_custkey""",
)


def _span(t: Tables) -> DataFrame:
    # pending orders stand under a key of their own, so some customers have none
    cust = F.when(F.col("o_orderstatus") == "P", -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))
    rows = t.orders.select(cust.alias("cust"), F.to_date("o_orderdate").alias("day"))
    return planning.date_watermark(rows, "cust", "day")


def _ranges(t: Tables) -> DataFrame:
    wanted = t.customer.select(F.col("c_custkey").alias("cust"))
    return planning.next_ranges(wanted, _span(t), "cust", "1995-03-01", "2001-06-30")


@query(
    "date_watermark",
    f"SELECT cust, {day_sql('min_date')} AS min_date, {day_sql('max_date')} AS max_date FROM order_span",
)
def date_watermark(t: Tables) -> DataFrame:
    return _span(t)


@query(
    "next_ranges",
    f"""SELECT cust, {day_sql('start_date')} AS start_date, {day_sql('end_date')} AS end_date, status
        FROM order_ranges""",
)
def next_ranges(t: Tables) -> DataFrame:
    return _ranges(t)


@query(
    "year_chunks",
    f"""SELECT cust, {day_sql('greatest(start_date, make_date(y, 1, 1))')} AS chunk_start,
        {day_sql('least(end_date, make_date(y, 12, 31))')} AS chunk_end
        FROM (SELECT *, unnest(generate_series(year(start_date), year(end_date))) AS y
              FROM order_ranges WHERE status = 'fetch')""",
)
def year_chunks(t: Tables) -> DataFrame:
    return planning.year_chunks(_ranges(t).where(F.col("status") == "fetch").drop("status"))


piece(
    "dates_missing",
    """SELECT date_col FROM order_calendar
       WHERE date_col < DATE '2001-07-20' AND date_col NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
       ORDER BY date_col DESC LIMIT 3""",
)


def _missing(t: Tables) -> DataFrame:
    from lakeloom.workload.models import order_calendar

    return planning.missing_dates(order_calendar(t), t.orders, "date_col", "o_orderdate", "2001-07-20", newest=3)


@query("missing_dates", f"SELECT {day_sql('date_col')} AS date_col FROM dates_missing")
def missing_dates(t: Tables) -> DataFrame:
    return _missing(t)


@query(
    "work_list",
    f"""SELECT s_name AS city, {day_sql('date_col')} AS date_col,
        strftime((date_col + INTERVAL 12 HOUR) AT TIME ZONE 'Australia/Sydney' AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS dt
        FROM supplier, dates_missing""",
)
def work_list(t: Tables) -> DataFrame:
    return planning.work_list(_missing(t), "date_col", t.supplier.select(F.col("s_name").alias("city")))


@query(
    "cursor_filter",
    f"""SELECT event_id, {time_sql('ts')} AS ts FROM events
        WHERE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') > '2024-01-15T00:00:00Z'""",
)
def cursor_filter(t: Tables) -> DataFrame:
    items = t.events.withColumn("published", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return planning.after_cursor(items, "published", "2024-01-15T00:00:00Z").select("event_id", "ts")


@query(
    "next_cursor",
    "SELECT greatest(max(strftime(ts, '%Y-%m-%dT%H:%M:%SZ')), '2024-01-15T00:00:00Z') AS cursor FROM events",
)
def next_cursor(t: Tables) -> DataFrame:
    items = t.events.withColumn("published", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return planning.next_cursor(items, "published", "2024-01-15T00:00:00Z")


@query(
    "status_rollup",
    """SELECT o_custkey, bool_or(s = 'success') AS any_success, bool_and(s = 'skipped') AS all_skipped,
       bool_and(s = 'failed') AS all_failed, count(*) FILTER (s = 'success') AS n_success
       FROM (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS s
             FROM orders) GROUP BY 1""",
)
def status_rollup(t: Tables) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", V.LOADED)
        .when(F.col("o_orderstatus") == "O", V.SKIPPED)
        .otherwise(V.FAILED)
    )
    return planning.status_rollup(t.orders.select("o_custkey", status.alias("status")), by=["o_custkey"])


@query(
    "loaded_range",
    f"""SELECT {time_sql('min(o_orderdate)')} AS min_date, {time_sql('max(o_orderdate)')} AS max_date FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def loaded_range(t: Tables) -> DataFrame:
    keys = t.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return planning.loaded_range(t.orders, "o_orderdate", keys, "o_custkey")


@query(
    "missing_spans",
    f"""WITH days AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
        stops AS (SELECT o_custkey, day AS span_start, day AS span_end FROM days
                  WHERE day BETWEEN DATE '1993-01-01' AND DATE '1997-12-31'
                  UNION ALL SELECT DISTINCT o_custkey, DATE '1998-01-01', NULL FROM days),
        gaps AS (SELECT o_custkey, CAST(coalesce(lag(span_end) OVER (PARTITION BY o_custkey ORDER BY span_start) + 1, DATE '1993-01-01') AS DATE) AS first,
                        span_start - 1 AS last FROM stops)
        SELECT o_custkey, {day_sql('first')} AS missing_start, {day_sql('CAST(last AS DATE)')} AS missing_end FROM gaps WHERE first <= last""",
)
def missing_spans(t: Tables) -> DataFrame:
    """Days of five years on which a customer has no order, as ranges."""
    days = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"))
    wanted = t.orders.select(
        "o_custkey", F.to_date(F.lit("1993-01-01")).alias("start_date"), F.to_date(F.lit("1997-12-31")).alias("end_date")
    ).distinct()
    return planning.missing_spans(wanted, planning.loaded_spans(days, "o_custkey", "day"), "o_custkey")


@query(
    "freshness",
    f"""SELECT o_custkey, {time_sql('newest')} AS max_loaded_at,
        CASE WHEN TIMESTAMP '2001-08-10' - newest > INTERVAL 365 DAY THEN 'error'
             WHEN TIMESTAMP '2001-08-10' - newest > INTERVAL 90 DAY THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY 1)""",
)
def freshness(t: Tables) -> DataFrame:
    as_of = _at("2001-08-10")
    return planning.freshness(t.orders, "o_orderdate", as_of, 90, 365, by=["o_custkey"])


# ================================================================ quality

_LINE_CHECKS = [
    quality.NotNull("l_partkey"),
    quality.NotNull("l_orderkey"),
    quality.Accepted("l_returnflag", ("A", "R")),
    quality.Between("l_quantity", 5, 45),
    quality.Between("l_discount", 0, 1),
    quality.Unique("l_orderkey"),
    quality.Unique("l_orderkey", "l_linenumber"),
    quality.Related("l_partkey", "big_parts", "p_partkey"),
]


@query(
    "quality_report",
    """WITH failures AS (
         SELECT 'not_null' AS "check", 'l_partkey' AS "column", count(*) FILTER (l_partkey IS NULL) AS failures FROM lineitem
         UNION ALL SELECT 'not_null', 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
         UNION ALL SELECT 'accepted_values', 'l_returnflag', count(*) FILTER (l_returnflag NOT IN ('A', 'R')) FROM lineitem
         UNION ALL SELECT 'between', 'l_quantity', count(*) FILTER (l_quantity NOT BETWEEN 5 AND 45) FROM lineitem
         UNION ALL SELECT 'between', 'l_discount', count(*) FILTER (l_discount NOT BETWEEN 0 AND 1) FROM lineitem
         UNION ALL SELECT 'unique', 'l_orderkey', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
         UNION ALL SELECT 'unique_combination', 'l_orderkey,l_linenumber', count(*)
                   FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
         UNION ALL SELECT 'relationships', 'l_partkey', count(*) FROM lineitem
                   WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10))
       SELECT *, CASE failures WHEN 0 THEN 'pass' ELSE 'fail' END AS status FROM failures""",
)
def quality_report(t: Tables) -> DataFrame:
    parents = {"big_parts": t.part.withColumn("p_partkey", F.when(F.col("p_size") > 10, F.col("p_partkey")))}
    return quality.run_checks(t.lineitem, _LINE_CHECKS, parents)


# ================================================================ streams


def _event_stream(t: Tables) -> DataFrame:
    schema = t.events.schema
    return ingest.landing_stream(t.spark, t.directory, schema, pattern="events.parquet")


@query(
    "stream_merge",
    """SELECT user_id, event_type, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_merge(t: Tables) -> DataFrame:
    """Last event per user and type, merged from a file stream."""
    target, marks = scratch_path(t.spark, "last-events"), scratch_path(t.spark, "marks")
    rows = _event_stream(t).select("user_id", "event_type", "event_id", "ts", "value")
    newest = ["ts", "event_id"]
    ingest.merge_stream(rows, target, marks, ["user_id", "event_type"], newest, buckets=8).awaitTermination()
    return versioned.read_table(t.spark, target).drop("ts")


@query(
    "stream_append",
    """SELECT user_id, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def stream_append(t: Tables) -> DataFrame:
    """First event per user; later ones never replace it."""
    target, marks = scratch_path(t.spark, "first-events"), scratch_path(t.spark, "marks")
    rows = _event_stream(t).select("user_id", "event_id", "ts", "value")
    oldest = [F.col("ts"), F.col("event_id")]
    ingest.append_stream(rows, target, marks, ["user_id"], oldest).awaitTermination()
    return t.spark.read.parquet(target).drop("ts", "load_batch")


@query("stream_without_repeats", "SELECT DISTINCT user_id, event_type FROM events")
def stream_without_repeats(t: Tables) -> DataFrame:
    """One row per user and type of event, from files that are read in two batches."""
    landed, target, marks = (scratch_path(t.spark, n) for n in ("landed", "kept-events", "marks"))
    t.events.repartition(6).write.parquet(landed)
    stream = ingest.landing_stream(t.spark, landed, t.events.schema, files_per_batch=3)
    rows = stream.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    once = ingest.without_repeats(rows, ["user_id", "event_type"], "ts", "4000 days", spread=["event_id"])
    ingest.write_stream(once, target, marks).awaitTermination()
    return t.spark.read.parquet(target).select("user_id", "event_type")


@query(
    "stream_first_of_keys",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def stream_first_of_keys(t: Tables) -> DataFrame:
    """One row per user and type of event, looked up in the index of earlier batches: no state, no horizon."""
    landed, target, marks = (scratch_path(t.spark, n) for n in ("landed", "first-of-keys", "marks"))
    t.events.repartition(6).write.parquet(landed)
    stream = ingest.landing_stream(t.spark, landed, t.events.schema, files_per_batch=2)
    rows = stream.select("event_id", "user_id", "event_type", "ts")
    oldest = [F.col("ts"), F.col("event_id")]
    ingest.indexed_stream(rows, target, marks, ["user_id", "event_type"], oldest).awaitTermination()
    return presence.read_batches(t.spark, target).select("user_id", "event_type")
