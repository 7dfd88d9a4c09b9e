"""Type-2 history kept as a base and the changes since, so that a run writes what changed.

``base/run=<label>`` holds all open rows as of a run. Every run writes the rows it opened and those
it closed; the open rows are the base, and what was opened since, without what was closed since,
merged on reading. Every so many runs the open rows are written whole as a new base. A run counts
once it is entered in ``done``, and writes the same folders when it is done again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.history import _changes, _opened, last_run, one_row_per_key, run_label
from lakeloom.operators.merge import read_if_exists, replace_table
from lakeloom.session import settle

#: runs between two bases; open rows are merged from at most so many runs
FOLD_EVERY = 32


def _runs(spark: SparkSession, path: str, upto: str) -> tuple[str, list[str]]:
    """Base that the open rows after a run rest on, and the runs after it."""
    done = spark.read.parquet(f"{path}/done").where(F.col("run") <= upto)
    entries = {r["run"]: r["base"] for r in done.select("run", "base").collect()}
    base = entries[upto]
    return base, sorted(run for run in entries if run > base)


def _part(spark: SparkSession, path: str, part: str, runs: Sequence[str]) -> DataFrame | None:
    return spark.read.parquet(*[f"{path}/{part}/run={r}" for r in runs]) if runs else None


def open_rows(spark: SparkSession, path: str, upto: str) -> DataFrame:
    """The open rows as of a run. What was closed since the base is small and is looked up by version."""
    base, later = _runs(spark, path, upto)
    rows = spark.read.parquet(f"{path}/base/run={base}")
    if not later:
        return rows
    rows = rows.unionByName(_part(spark, path, "opened", later))
    return rows.join(_part(spark, path, "closed", later).select("dbt_scd_id"), "dbt_scd_id", "left_anti").select(*rows.columns)


def snapshot_changes(
    source: DataFrame,
    path: str,
    key: str,
    check_cols: Sequence[str],
    run_at: str,
    fold_every: int = FOLD_EVERY,
) -> None:
    """One run, by the rules of ``snapshot``: reads the open rows and the source, writes what changed."""
    spark, path = source.sparkSession, path.rstrip("/")
    label, at = run_label(run_at), F.lit(run_at).cast("timestamp_ntz")
    rows = one_row_per_key(source, key)
    last = last_run(spark, path, label)
    if last is None:
        replace_table(_opened(rows, key, at), f"{path}/base/run={label}")
        base = label
    else:
        base, later = _runs(spark, path, last)
        before = open_rows(spark, path, last)
        is_closed, is_new = F.col("dbt_valid_to").isNotNull(), F.col("dbt_valid_from") == at
        changed = settle(_changes(before, rows, key, check_cols, at).where(is_closed | is_new), "history-changes")
        replace_table(changed.where(is_closed), f"{path}/closed/run={label}")
        replace_table(changed.where(~is_closed), f"{path}/opened/run={label}")
        if len(later) + 1 >= fold_every:
            merged = before.join(changed.where(is_closed).select("dbt_scd_id"), "dbt_scd_id", "left_anti")
            replace_table(merged.select(*before.columns).unionByName(changed.where(~is_closed)), f"{path}/base/run={label}")
            base = label
    entry = spark.range(1).select(F.lit(run_at).alias("run_at"), F.lit(base).alias("base"))
    replace_table(entry, f"{path}/done/run={label}")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All versions, open and closed, as of the last run."""
    path = path.rstrip("/")
    last = last_run(spark, path)
    if last is None:
        raise LookupError(f"no run under {path}")
    current = open_rows(spark, path, last)
    closed = read_if_exists(spark, f"{path}/closed")
    if closed is None:
        return current
    return current.unionByName(closed.where(F.col("run") <= last).drop("run"))
