"""Incremental loads as Structured Streaming jobs.

The stream's checkpoint remembers which files were read, which is what the state document of a
batch load is for. With ``available_now`` a job takes what has landed and ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.functions.columns import any_of
from lakeloom.operators.merge import (
    latest_per_key,
    new_rows,
    read_if_exists,
    replace_table,
    upsert_table,
)
from lakeloom.operators.presence import append_indexed
from lakeloom.operators.versioned import merge_table
from lakeloom.session import settle


def landing_stream(
    spark: SparkSession,
    path: str,
    schema,
    file_format: str = "parquet",
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(file_format)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _start(writer, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def merge_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
    partition_by: Sequence[str] = (),
    available_now: bool = True,
    interval: str = "1 minute",
    buckets: int | None = None,
) -> StreamingQuery:
    """Merge each micro-batch into the table at ``target``.

    With ``buckets`` the table is a bucketed one with versions (``read_table`` reads it): a micro-batch
    writes the buckets it falls into, and readers see whole versions. That is the way for large
    tables; else all rows, or with ``partition_by`` whole partitions, are written again. A batch
    that is replayed after a failure merges the same rows again, to the same result.
    """
    if buckets and partition_by:
        raise ValueError("a table has buckets or partitions")

    def merge(batch: DataFrame, _batch_id: int) -> None:
        if buckets:
            merge_table(batch, target, keys, newest_first, buckets)
        else:
            upsert_table(batch, target, keys, newest_first, partition_by)

    return _start(stream.writeStream.foreachBatch(merge), checkpoint, available_now, interval)


def append_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append the rows whose key is not in the table yet; a known key is never updated.

    Repeats inside the batch are cut down on the map side, so a key with many copies costs
    no more than one row per task. Rows without a key always pass. Each micro-batch owns the
    partition ``load_batch=<id>`` and is compared with the others, so replaying it after a
    failure writes the same partition again.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        stored = read_if_exists(batch.sparkSession, target)
        if stored is not None:
            stored = stored.where(F.col("load_batch") != batch_id)
        no_key = any_of([F.col(k).isNull() for k in keys])
        once = settle(latest_per_key(batch.where(~no_key), keys, newest_first), "micro-batch")
        fresh = new_rows(stored, once, keys, few=True).unionByName(batch.where(no_key))
        replace_table(fresh, f"{target}/load_batch={batch_id}")

    return _start(stream.writeStream.foreachBatch(append), checkpoint, available_now, interval)


def indexed_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append the first row of each key, however long ago its repeats came; ``read_batches`` reads the table.

    Each micro-batch is looked up in the presence index of all earlier ones, and only batches
    that may hold one of its keys are read. So no state of all keys is kept, no horizon is set,
    and no late row is dropped. A replayed micro-batch is written again under its own id.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        append_indexed(batch, target, f"{batch_id:012d}", keys, newest_first)

    return _start(stream.writeStream.foreachBatch(append), checkpoint, available_now, interval)


def without_repeats(
    stream: DataFrame, keys: Sequence[str], time: str, delay: str, spread: Sequence[str] = (), ways: int | None = None
) -> DataFrame:
    """The first row of each key, repeats within ``delay`` dropped.

    With ``spread`` (columns that differ between copies, such as the file and row they came
    from) copies are first dropped within sub-keys, so that one key with very many copies
    is met by many tasks before the few that are left meet in one: ``ways`` of them, by default
    as many as the session shuffles to.
    """
    rows = stream.withWatermark(time, delay)
    if spread:
        ways = ways or int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64(*spread), F.lit(ways))
        rows = (
            rows.withColumn("__part", part)
            .dropDuplicatesWithinWatermark([*keys, "__part"])
            .drop("__part")
        )
    return rows.dropDuplicatesWithinWatermark(list(keys))


def write_stream(
    stream: DataFrame, target: str, checkpoint: str, available_now: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", target)
    return _start(writer, checkpoint, available_now, interval)
