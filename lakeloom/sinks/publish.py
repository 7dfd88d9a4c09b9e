"""Publishing tables by layer."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from lakeloom.operators.history import current_rows
from lakeloom.operators.quality import (
    Check,
    Related,
    Unique,
    enforce_contract,
    observed,
    observed_failures,
    run_checks,
)
from lakeloom.session import move_folder, remove_folder, subfolders


class EmptyInput(RuntimeError):
    pass


class ChecksFailed(RuntimeError):
    """A version that was written but does not pass its checks; it did not become current."""


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Stop a build whose input is empty. Reads no more than it takes to see one row."""
    if df.isEmpty():
        raise EmptyInput(f"{name} has no rows; nothing downstream is built")
    return df


def publish(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    version: str,
    contract: T.StructType | None = None,
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
    checks: Sequence[Check] = (),
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Write one version of a table, enter it as current, point the view ``<layer>__<name>`` at it.

    Each version has a directory of its own, so readers of the version before are not
    disturbed, and a failed write is simply written again. A version that fails one of its
    ``checks`` is not entered, and the build stops. ``sort_by`` orders the rows within
    each file, which narrows the ranges the files are skipped by; it is no order of the table.
    Checks on one row are counted while the rows are written; only keys and references are
    looked up afterwards.
    """
    if contract is not None:
        df = enforce_contract(df, contract)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    path = f"{root.rstrip('/')}/{layer}/{name}/version={version}"
    current = F.col("dbt_valid_to").isNull() if "dbt_valid_to" in df.columns else None
    schema = df.schema
    df, observation = observed(df, checks, current)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_by
    ).parquet(path)
    published = df.sparkSession.read.schema(schema).parquet(path)
    failed = [f for f in observed_failures(checks, observation) if f[2]]
    others = [c for c in checks if isinstance(c, (Unique, Related))]
    if others:
        rows = current_rows(published) if current is not None else published
        found = run_checks(rows, others, parents or {}).where("status = 'fail'").collect()
        failed += [(r["check"], r["column"], r["failures"]) for r in found]
    if failed:
        shown = ", ".join(f"{check} of {column} ({n})" for check, column, n in failed)
        raise ChecksFailed(f"{layer}.{name}, version {version}: {shown}")
    _enter(df.sparkSession, root, layer, name, version, observation.get["row_count"])
    published.createOrReplaceTempView(f"{layer}__{name}")
    return published


def publish_view(df: DataFrame, layer: str, name: str) -> DataFrame:
    """A table that is computed whenever it is read."""
    df.createOrReplaceTempView(f"{layer}__{name}")
    return df


def listed(df: DataFrame, *descending: str) -> DataFrame:
    """Rows in descending order of the columns, nulls last, for reading a table as a list."""
    return df.orderBy(*[F.desc_nulls_last(c) for c in descending])


def published(spark: SparkSession, layer: str, name: str) -> DataFrame:
    return spark.table(f"{layer}__{name}")


def _entries(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}__versions"


class PublishedMeanwhile(RuntimeError):
    """Another publisher entered a version first; this one's rows are written but not current."""


def _places(spark: SparkSession, root: str, layer: str, name: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in subfolders(spark, _entries(root, layer, name)) if n.startswith("place="))


def _enter(spark: SparkSession, root: str, layer: str, name: str, version: str, row_count: int) -> None:
    """Enter a version as current: one place holds one entry, and the later of two publishers fails."""
    place = max(_places(spark, root, layer, name), default=0) + 1
    written = f"{_entries(root, layer, name)}/_new-{uuid.uuid4().hex}"
    entry = spark.range(1).select(F.lit(version).alias("version"), F.lit(row_count).cast("long").alias("row_count"))
    entry.write.parquet(written)
    if not move_folder(spark, written, f"{_entries(root, layer, name)}/place={place}"):
        raise PublishedMeanwhile(f"{layer}.{name}: place {place} was taken while version {version} was published")


def current_version(spark: SparkSession, root: str, layer: str, name: str) -> str | None:
    """The version that was entered last, whichever session published it."""
    places = _places(spark, root, layer, name)
    if not places:
        return None
    return spark.read.parquet(f"{_entries(root, layer, name)}/place={places[-1]}").head()["version"]


def load_log(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """place, version and row_count of every version that became current."""
    return spark.read.parquet(_entries(root, layer, name)).select("place", "version", "row_count")


def remove_old_versions(spark: SparkSession, root: str, layer: str, name: str, keep: int = 2) -> list[str]:
    """Remove the rows of versions entered before the last ``keep`` ones; their entries stay. Returns their names."""
    entered = load_log(spark, root, layer, name).orderBy("place").select("version").collect()
    order = [r["version"] for r in entered]
    kept = set(order[-max(1, keep) :])
    folders = subfolders(spark, f"{root.rstrip('/')}/{layer}/{name}")
    gone = sorted({v for v in order if v not in kept and f"version={v}" in folders})
    for version in gone:
        remove_folder(spark, f"{root.rstrip('/')}/{layer}/{name}/version={version}")
    return gone


def read_current(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    version = current_version(spark, root, layer, name)
    if version is None:
        raise LookupError(f"no version of {layer}.{name} is published under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{layer}/{name}/version={version}")
