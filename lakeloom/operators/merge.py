"""Load dispositions: replace, append, merge by key, incremental append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.functions.columns import any_of, content_hash
from lakeloom.operators.joins import anti_join, null_safe_on
from lakeloom.session import remove_folder, settle


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column | str]) -> DataFrame:
    """The last row of each key; a name in ``newest_first`` means that column, descending.

    ``row_number() = 1`` is limited on the map side already (WindowGroupLimit), so of a key
    with very many rows each task sends one. The content hash settles ties the same way on
    every rerun.
    """
    named = [F.col(c).desc() if isinstance(c, str) else c for c in newest_first]
    order = [*named, content_hash(df).desc()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def merge_by_key(
    target: DataFrame | None,
    updates: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
) -> DataFrame:
    """Upsert: last update per key wins, target rows not updated stay.

    Columns that only one side has are kept and filled with null.
    """
    latest = latest_per_key(updates, keys, newest_first)
    if target is None:
        return latest
    latest = settle(latest, "updates")  # read twice below
    return anti_join(target, latest, keys).unionByName(latest, allowMissingColumns=True)


def new_rows(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], few: bool = False
) -> DataFrame:
    """Source rows whose key the target does not hold yet; rows without a key always pass.

    Set ``few`` if the source is a batch that is small beside the target. The target is then
    first reduced to the keys of the batch, which Spark can do by broadcasting them, so that a
    large target is scanned but not shuffled.
    """
    if target is None:
        return source
    if few:
        target = target.select(*keys).join(source.select(*keys).distinct(), list(keys), "left_semi")
    return anti_join(source, target, keys, repeated=True)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _without_key(keys: Sequence[str]) -> Column:
    return any_of([F.col(k).isNull() for k in keys])


def _not_stored(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` less those without a key that are stored already, column for column.

    A row without a key has no identity but its content, so a load that is done again would
    multiply it.
    """
    same = [c for c in rows.columns if c in stored.columns]
    marked = rows.withColumn("__mark", content_hash(rows.select(*same)))
    seen = stored.where(_without_key(keys)).select(*[F.col(c).cast(rows.schema[c].dataType) for c in same])
    seen = seen.select(content_hash(seen).alias("__mark")).distinct()
    fresh = marked.where(_without_key(keys)).join(seen, "__mark", "left_anti")
    return rows.where(~_without_key(keys)).unionByName(fresh.drop("__mark"))


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Incremental append. Running it again with the same input adds nothing.

    Rows without a key always pass, unless the table holds the same row already.
    """
    target = read_if_exists(df.sparkSession, path)
    fresh = df if target is None else _not_stored(new_rows(target, df, keys), target, keys)
    append_table(fresh, path)


def _touched_partitions(target: DataFrame, latest: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows of ``target`` in partitions that ``latest`` has rows for.

    The span of each partition column goes into a filter, so partitions beyond it are not even
    listed for reading; the semi-join decides among the rest.
    """
    typed = target.withColumns(
        {
            c: F.col(c).cast(latest.schema[c].dataType)
            for c in partition_by
            if target.schema[c].dataType != latest.schema[c].dataType
        }
    )
    bounds = [f(c).alias(f"{n}_{i}") for i, c in enumerate(partition_by) for n, f in (("least", F.min), ("most", F.max))]
    span = latest.agg(*bounds, *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(partition_by)]).head()
    for i, c in enumerate(partition_by):
        inside = F.col(c).between(F.lit(span[f"least_{i}"]), F.lit(span[f"most_{i}"]))
        typed = typed.where(inside | F.col(c).isNull() if span[f"nulls_{i}"] else inside)
    touched = latest.select(*partition_by).distinct()
    return typed.join(touched, null_safe_on(typed, touched, partition_by), "left_semi")


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}__pending"


def _overwrite(merged: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    writer = merged.write.mode("overwrite")
    if partition_by:
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    else:
        writer.option("partitionOverwriteMode", "static").parquet(path)


def finish_pending(spark: SparkSession, path: str) -> bool:
    """Carry out the last step of a merge that was interrupted in it; says whether there was one.

    What is to be written stands beside the table, whole, before the table is touched, so the step
    can be done again from there however far it got.
    """
    ready = read_if_exists(spark, f"{_pending(path)}/ready")
    if ready is None:
        return False
    rows = spark.read.parquet(f"{_pending(path)}/rows")
    _overwrite(rows, path, [c for c in ready.head()["partition_by"]])
    remove_folder(spark, f"{_pending(path)}/ready")  # first, so that no half of the rows is taken for all
    remove_folder(spark, _pending(path))
    return True


def upsert_table(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
    partition_by: Sequence[str] = (),
) -> None:
    """Merge ``updates`` into the table at ``path``.

    With ``partition_by`` only the partitions that the updates touch are read and rewritten;
    those columns must belong to the key, else a changed row could stay behind in its old
    partition.

    The merged rows are written to ``<path>__pending`` and entered as ready there before the
    table is overwritten from them. A job that dies before that leaves the table as it was; one
    that dies later is finished by the next call (or ``finish_pending``) from the rows that are
    ready. The same updates again give the same table; rows without a key are added once.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the merge key")
    spark = updates.sparkSession
    finish_pending(spark, path)
    latest = settle(latest_per_key(updates, keys, newest_first), "updates")
    target = read_if_exists(spark, path)
    if target is not None and partition_by:
        target = _touched_partitions(target, latest, partition_by)
    if target is None:
        merged = latest
    else:
        kept = anti_join(target, latest, keys)
        merged = kept.unionByName(_not_stored(latest, target, keys), allowMissingColumns=True)
    replace_table(merged, f"{_pending(path)}/rows")
    named = F.array(*[F.lit(c) for c in partition_by]).cast("array<string>")
    replace_table(spark.range(1).select(named.alias("partition_by")), f"{_pending(path)}/ready")
    finish_pending(spark, path)
