"""Type-2 history: one open row per key, closed rows for what it was before."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.columns import all_of
from lakeloom.operators.merge import read_if_exists, replace_table
from lakeloom.session import settle



def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """``df``, failing as soon as a key that is missing or repeated is met.

    The check rides on the aggregation that brings the keys together anyway; copies of one key
    are merged on the map side.
    """
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("__row")
    )
    ok = F.col(key).isNotNull() & (F.col("__n") == 1)
    message = F.concat(F.lit(f"{key} is missing or repeated: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    checked = F.when(ok, F.col("__row")).otherwise(F.raise_error(message))
    return grouped.select(key, checked.alias("__row")).select(key, "__row.*").select(*df.columns)


def version_id(key: Column | str, at: Column) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), at.cast("string")))


def _opened(rows: DataFrame, key: str, run_at: Column) -> DataFrame:
    return rows.select(
        *rows.columns,
        version_id(key, run_at).alias("dbt_scd_id"),
        run_at.alias("dbt_updated_at"),
        run_at.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def _changes(current: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str], at: Column) -> DataFrame:
    """Open rows after a run, and those the run closes: one row per key on both sides joined."""
    pairs = current.select(F.col(key), F.struct(*current.columns).alias("old")).join(
        source.select(F.col(key), F.struct(*source.columns).alias("new")), key, "full_outer"
    )
    same = all_of([F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_cols])
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    stays = has_old & has_new & same

    old_row = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in current.columns if c != "dbt_valid_to"],
        F.when(~stays, at).alias("dbt_valid_to"),
    )
    new_row = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in source.columns],
        version_id(F.col(key), at).alias("dbt_scd_id"),
        at.alias("dbt_updated_at"),
        at.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )
    versions = F.array(F.when(has_old, old_row), F.when(has_new & ~stays, new_row))
    present = F.filter(versions, lambda r: r.isNotNull())
    return pairs.select(F.inline(present)).select(*current.columns)


def snapshot(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_at: str,
) -> DataFrame:
    """History after one more run.

    Open rows whose checked columns differ (null-safe) are closed and replaced, open rows whose
    key left the source are closed, keys without an open row are opened. Closed rows are only
    passed through. Running again with the same source changes nothing.
    """
    at = F.lit(run_at).cast("timestamp_ntz")
    source = one_row_per_key(source, key)
    if history is None:
        return _opened(source, key, at)
    closed_before = history.where(F.col("dbt_valid_to").isNotNull())
    return closed_before.unionByName(_changes(current_rows(history), source, key, check_cols, at))


def snapshot_table(
    source: DataFrame, path: str, key: str, check_cols: Sequence[str], run_at: str
) -> None:
    """One run on a history kept on disk, at a cost that does not grow with the history.

    ``open/run=...`` holds the open rows after each run and ``closed/run=...`` the rows that run
    closed. A run reads the open rows of the run before it and writes its own two directories;
    rows closed earlier are neither read nor written. A run counts once it is entered in
    ``done``; until then, and when it is done again, it writes the same directories again.
    """
    spark = source.sparkSession
    label = run_label(run_at)
    at = F.lit(run_at).cast("timestamp_ntz")
    rows = one_row_per_key(source, key)
    last = last_run(spark, path, label)
    if last is None:
        replace_table(_opened(rows, key, at), f"{path}/open/run={label}")
    else:
        before = spark.read.parquet(f"{path}/open/run={last}")
        changed = settle(_changes(before, rows, key, check_cols, at), "history-changes")
        replace_table(changed.where(F.col("dbt_valid_to").isNotNull()), f"{path}/closed/run={label}")
        replace_table(changed.where(F.col("dbt_valid_to").isNull()), f"{path}/open/run={label}")
    replace_table(spark.range(1).select(F.lit(run_at).alias("run_at")), f"{path}/done/run={label}")


def run_label(run_at: str) -> str:
    """``2025-05-01 06:00:00`` as a directory name that sorts by time and stays text."""
    return "r" + re.sub(r"[^0-9]", "-", run_at)


def last_run(spark: SparkSession, path: str, before: str | None = None) -> str | None:
    """The last run that is done (earlier than ``before``)."""
    done = read_if_exists(spark, f"{path}/done")
    if done is None:
        return None
    earlier = done if before is None else done.where(F.col("run") < before)
    return earlier.agg(F.max("run")).head()[0]


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions, open and closed, of a history kept by ``snapshot_table``."""
    last = last_run(spark, path)
    current = spark.read.parquet(f"{path}/open/run={last}")
    closed = read_if_exists(spark, f"{path}/closed")
    if closed is None:
        return current
    return current.unionByName(closed.where(F.col("run") <= last).drop("run"))


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("dbt_valid_to").isNull())
