"""What to load next: counts, change gates, date ranges, missing dates, cursors, roll-ups.

A plan is a small DataFrame with one row per key; whatever fetches the data reads it. ``as_of``
is always a parameter, so a plan can be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import fixed_values as V
from lakeloom.functions.columns import local_day_before, utc_text_of_local_noon

# ---------------------------------------------------------------- counts


def count_per_key(df: DataFrame, key: str, alias: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def counts_per_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# ---------------------------------------------------------------- change gates


def _gate_inputs(incoming: DataFrame, stored: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Counts per key: ``incoming``, ``stored`` (0 if none) and ``previous`` (0 if never loaded)."""
    return (
        incoming.select(key, "incoming")
        .join(stored.select(key, "stored"), key, "left")
        .join(state.select(key, "previous"), key, "left")
        .na.fill(0, ["incoming", "stored", "previous"])
    )


def _gated(counts: DataFrame, action: Column, remember: Column) -> DataFrame:
    return counts.withColumn("action", action).withColumn("next_previous", remember)


def reload_gate(incoming: DataFrame, stored: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Reload if the table lost rows or is empty; else skip if the feed has the same size."""
    lost = (F.col("stored") < F.col("previous")) | (F.col("stored") == 0)
    action = (
        F.when(lost, "reload").when(F.col("incoming") == F.col("previous"), "skip").otherwise("load")
    )
    remember = F.when(F.col("action") == "skip", F.col("previous")).otherwise(F.col("incoming"))
    return _gated(_gate_inputs(incoming, stored, state, key), action, remember)


def count_gate(
    incoming: DataFrame, stored: DataFrame, state: DataFrame, key: str, heed_table: bool = True
) -> DataFrame:
    """Skip if the feed has the size of the last load, unless the table has lost rows.

    With ``heed_table=False`` only the two feed sizes are compared.
    """
    lost = F.lit(heed_table) & (F.col("stored") < F.col("previous"))
    action = (
        F.when(lost, "reload").when(F.col("incoming") == F.col("previous"), "skip").otherwise("load")
    )
    remember = F.when(F.col("action") == "skip", F.col("previous")).otherwise(F.col("incoming"))
    return _gated(_gate_inputs(incoming, stored, state, key), action, remember)


def growth_gate(
    incoming: DataFrame,
    stored: DataFrame,
    state: DataFrame,
    key: str,
    page_size: int = V.BOOK_PAGE_SIZE,
) -> DataFrame:
    """Load what grew; skip what did not change and is stored; load what shrank or is gone."""
    action = (
        F.when(F.col("previous") < F.col("incoming"), "load")
        .when((F.col("stored") > 0) & (F.col("incoming") == F.col("previous")), "skip")
        .otherwise("load")
    )
    remember = F.when(F.col("action") == "skip", F.col("previous")).otherwise(F.col("incoming"))
    pages = F.ceil(F.col("incoming") / page_size)
    return _gated(_gate_inputs(incoming, stored, state, key), action, remember).withColumn("pages", pages)


def advance_state(state: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """State after the run: decided keys get what the gate says to remember, others stay."""
    new = decisions.select(key, F.col("next_previous").alias("__new"))
    return state.join(new, key, "full_outer").select(
        key, F.coalesce("__new", "previous").alias("previous")
    )


# ---------------------------------------------------------------- date ranges


def date_watermark(df: DataFrame, key: str, day: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def next_ranges(
    wanted: DataFrame,
    watermark: DataFrame,
    key: str,
    base_start: Column | str,
    end: Column | str,
) -> DataFrame:
    """Range still to load per wanted key, with ``status`` 'fetch' or 'skipped'.

    A key is complete if it spans as many days as asked for and reaches the end. Otherwise it
    goes on after its last day; holes inside its span are not looked at (see missing_dates).
    """
    base = F.lit(base_start).cast("date")
    last = F.lit(end).cast("date")
    known = F.col("max_date").isNotNull()
    expected = F.date_diff(last, base) + 1
    existing = F.date_diff("max_date", "min_date") + 1
    complete = known & (existing >= expected) & (F.col("max_date") >= last)
    start = F.when(known, F.greatest(F.date_add("max_date", 1), base)).otherwise(base)
    return (
        wanted.select(key)
        .join(watermark, key, "left")
        .select(
            key,
            start.alias("start_date"),
            last.alias("end_date"),
            F.when(complete | (start > last), F.lit(V.SKIPPED)).otherwise(F.lit("fetch")).alias("status"),
        )
    )


def loaded_spans(df: DataFrame, key: str, day: str) -> DataFrame:
    """(key, span_start, span_end): the stretches of days in a row that each key has loaded."""
    days = df.where(F.col(day).isNotNull()).select(key, F.col(day).cast("date").alias("__day")).distinct()
    # days in a row less their number are one and the same day
    number = F.row_number().over(Window.partitionBy(key).orderBy("__day"))
    island = F.date_sub("__day", number)
    return (
        days.withColumn("__island", island)
        .groupBy(key, "__island")
        .agg(F.min("__day").alias("span_start"), F.max("__day").alias("span_end"))
        .drop("__island")
    )


def missing_spans(
    wanted: DataFrame, spans: DataFrame, key: str, start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """(key, missing_start, missing_end): what of each wanted range no loaded span covers, holes included.

    The exact counterpart of ``next_ranges``, which looks at the first and last day only. ``spans``
    are those of ``loaded_spans``, or any that do not overlap; ranges that end before they start
    want nothing.
    """
    asked = wanted.where(F.col(start) <= F.col(end)).select(
        key, F.col(start).cast("date").alias("__first"), F.col(end).cast("date").alias("__last")
    )
    inside = asked.join(spans.where(F.col(key).isNotNull()), key).where(
        (F.col("span_start") <= F.col("__last")) & (F.col("span_end") >= F.col("__first"))
    )
    # each covered stretch ends what may be missing before it, and so does the end of the range
    stops = inside.select(key, "__first", "__last", "span_start", "span_end").unionByName(
        asked.withColumns({"span_start": F.date_add("__last", 1), "span_end": F.lit(None).cast("date")})
    )
    ordered = Window.partitionBy(key, "__first", "__last").orderBy("span_start")
    return (
        stops.withColumn("missing_start", F.coalesce(F.date_add(F.lag("span_end").over(ordered), 1), "__first"))
        .withColumn("missing_end", F.date_sub("span_start", 1))
        .where(F.col("missing_start") <= F.col("missing_end"))
        .select(key, "missing_start", "missing_end")
    )


def year_chunks(ranges: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Split each range at the turns of the year. A range that ends before it starts has none."""
    others = [c for c in ranges.columns if c not in (start, end)]
    years = F.sequence(F.year(start), F.year(end))
    first = F.make_date(F.col("__y"), F.lit(1), F.lit(1))
    last = F.make_date(F.col("__y"), F.lit(12), F.lit(31))
    return (
        ranges.where(F.col(start) <= F.col(end))
        .select(*others, start, end, F.explode(years).alias("__y"))
        .select(
            *others,
            F.greatest(F.col(start), first).alias("chunk_start"),
            F.least(F.col(end), last).alias("chunk_end"),
        )
    )


def weather_end(as_of: Column | str) -> Column:
    """Last day the archive is asked for: two days before today in Sydney."""
    return local_day_before(as_of, 2)


def missing_dates(
    days: DataFrame,
    loaded: DataFrame,
    day: str,
    loaded_day: str,
    as_of: Column | str,
    newest: int = V.MISSING_DATE_LIMIT,
) -> DataFrame:
    """The newest days up to the day before ``as_of`` for which nothing is loaded."""
    due = F.date_sub(F.lit(as_of).cast("date"), 1)
    have = loaded.select(F.col(loaded_day).cast("date").alias(day)).distinct()
    return (
        days.where(F.col(day) <= due)
        .join(have, day, "left_anti")
        .select(day)
        .orderBy(F.col(day).desc())
        .limit(newest)
    )


def work_list(
    dates: DataFrame, day: str, places: DataFrame, zone: str = V.SYDNEY, newest: int = V.MISSING_DATE_LIMIT
) -> DataFrame:
    """One request per place and date, stamped with local noon in UTC.

    The ``newest`` of the dates (as in ``missing_dates``, whose result they usually are) become one
    array value, a scalar subquery, that each place explodes; places are read once, in place.
    """
    few = dates.select(day).orderBy(F.col(day).desc()).limit(newest)
    listed = few.agg(F.sort_array(F.collect_list(day)).alias("dates")).scalar()
    return places.select("*", F.explode(listed).alias(day)).withColumn(
        "dt", utc_text_of_local_noon(day, zone)
    )


# ---------------------------------------------------------------- cursors and roll-ups


def after_cursor(df: DataFrame, published: str, cursor: str | None, inclusive: bool = False) -> DataFrame:
    """Items published after the cursor (all of them on the first run).

    ``inclusive`` also returns those at the cursor; merge by key then removes repeats.
    """
    if cursor is None:
        return df
    return df.where(F.col(published) >= cursor if inclusive else F.col(published) > cursor)


def next_cursor(df: DataFrame, published: str, cursor: str | None) -> DataFrame:
    """Highest time seen so far, whatever order the pages came in."""
    return df.agg(F.greatest(F.max(published), F.lit(cursor).cast("string")).alias("cursor"))


def status_rollup(statuses: DataFrame, status: str = "status", by: Sequence[str] = ()) -> DataFrame:
    """Did anything load, was all of it skipped, did all of it fail, how many loaded."""
    s = F.col(status)
    skipped = s.isin(V.UNCHANGED, V.SKIPPED)
    return statuses.groupBy(*by).agg(
        F.coalesce(F.bool_or(s == V.LOADED), F.lit(False)).alias("any_success"),
        F.coalesce(F.bool_and(F.coalesce(skipped, F.lit(False))), F.lit(True)).alias("all_skipped"),
        F.coalesce(F.bool_and(F.coalesce(s == V.FAILED, F.lit(False))), F.lit(True)).alias("all_failed"),
        F.count_if(s == V.LOADED).alias("n_success"),
    )


def loaded_range(df: DataFrame, day: str, keys: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """First and last day over the rows of the keys that were loaded."""
    if keys is not None:
        df = df.join(keys.select(key).distinct(), key, "left_semi")
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def freshness(
    df: DataFrame, loaded_at: str, as_of: Column, warn_days: int, error_days: int, by: Sequence[str] = ()
) -> DataFrame:
    """Age of the newest row against the two limits. No rows at all is an error."""
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), as_of)
    status = (
        F.when(age.isNull() | (age > error_days * 86400), "error")
        .when(age > warn_days * 86400, "warn")
        .otherwise("pass")
    )
    newest = df.groupBy(*by).agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    return newest.withColumn("status", status)
