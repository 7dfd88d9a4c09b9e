"""Price measures kept as one mergeable row per stock, so that a run reads its batch and no history.

A summary holds what the measures need of all ticks so far: extremes, the first and the last tick by
(time, id), and the number of ids. Summaries of any parts of the ticks merge into the summary of
the whole, in any order, and late ticks are no exception: they move the first tick, or nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.columns import round_money
from lakeloom.operators import presence
from lakeloom.operators.merge import replace_table
from lakeloom.operators.windows import price_movement
from lakeloom.session import move_folder, settle, subfolders

def summarise(
    ticks: DataFrame, stock: str = "stock", price: str = "price", time: str = "datetime", row_id: str = "id"
) -> DataFrame:
    """One row per stock: high, low, entries, opened and closed (the first and last tick by time, then id).

    Ticks without a time come last, ticks without an id last among those of a time, as in the
    measures over all ticks. Partial results merge on the map side, so one stock may hold most ticks.
    """
    tick = F.struct(
        F.col(time).isNull().alias("no_time"),
        F.col(time).alias("time"),
        F.col(row_id).isNull().alias("no_id"),
        F.col(row_id).alias("id"),
        F.col(price).alias("price"),
    )
    return ticks.groupBy(F.col(stock).alias("stock")).agg(
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.count(row_id).alias("entries"),
        F.min(tick).alias("opened"),
        F.max(tick).alias("closed"),
    )


def merge_summaries(*parts: DataFrame) -> DataFrame:
    """The summary of all ticks that the given summaries are of."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first.groupBy("stock").agg(
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("entries").alias("entries"),
        F.min("opened").alias("opened"),
        F.max("closed").alias("closed"),
    )


def profile(summary: DataFrame, stock: str = "stock") -> DataFrame:
    """What ``price_movement`` joins to the ticks."""
    return summary.select(
        F.col("stock").alias(stock),
        round_money(F.col("high") - F.col("low")).alias("spread"),
        round_money(F.col("closed.price") - F.col("opened.price")).alias("first_to_last"),
        F.col("opened.price").alias("first_price"),
        "entries",
    )


#: batches whose summaries are read one by one before they are folded into one
FOLD_AT = 64


def append_measured(
    ticks: DataFrame,
    path: str,
    batch: str,
    stock: str = "stock",
    price: str = "price",
    time: str = "datetime",
    row_id: str = "id",
    fold_at: int = FOLD_AT,
) -> DataFrame:
    """Append the ticks of a batch that are new (by id), measured over all ticks so far; returns them.

    Reads the batch, the presence indexes and the summaries, never the ticks stored before. A tick
    whose id is stored already is not counted again. Loading a batch again under its id gives the
    same rows, as long as no later batch has been loaded.
    """
    spark, path = ticks.sparkSession, path.rstrip("/")
    added = presence.append_indexed(ticks, path, batch, [row_id])
    replace_table(summarise(added, stock, price, time, row_id), f"{path}/summaries/batch={batch}")
    whole = settle(summary_of(spark, path), "summary")
    fold_summaries(spark, path, whole, fold_at)
    return price_movement(added, stock, price, time, row_id, profile=profile(whole, stock))


def _folds(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in subfolders(spark, f"{path}/folds"))


def _last_fold(spark: SparkSession, path: str) -> tuple[str | None, set[str]]:
    """Folder of the newest fold, and the batches it is of."""
    numbers = _folds(spark, path)
    if not numbers:
        return None, set()
    folder = f"{path}/folds/fold={numbers[-1]}"
    return folder, {r[0] for r in spark.read.parquet(f"{folder}/batches").collect()}


def summary_of(spark: SparkSession, path: str) -> DataFrame:
    """The summary of all batches that count: the newest fold, and the batches that came after it."""
    folder, folded = _last_fold(spark, path)
    parts = [] if folder is None else [spark.read.parquet(f"{folder}/summary")]
    fresh = [b for b in presence.batches(spark, path) if b not in folded]
    if fresh:
        parts.append(spark.read.parquet(*[f"{path}/summaries/batch={b}" for b in fresh]))
    if not parts:
        raise LookupError(f"no batch under {path}")
    return merge_summaries(*parts)


def fold_summaries(spark: SparkSession, path: str, whole: DataFrame, fold_at: int = FOLD_AT) -> bool:
    """Keep ``whole`` as the summary of all batches so far, if ``fold_at`` batches came since the last fold."""
    _, folded = _last_fold(spark, path)
    known = presence.batches(spark, path)
    if len(set(known) - folded) < fold_at:
        return False
    written = f"{path}/_fold-{uuid.uuid4().hex}"
    whole.write.parquet(f"{written}/summary")
    spark.createDataFrame([(b,) for b in known], "batch string").coalesce(1).write.parquet(f"{written}/batches")
    return move_folder(spark, written, f"{path}/folds/fold={max([0, *_folds(spark, path)]) + 1}")
