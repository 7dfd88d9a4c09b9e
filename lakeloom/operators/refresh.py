"""Trailing measures kept on disk, of which late or changed rows replace only the frames they are in.

The measured table lies in slots (months, say) and has versions; beside it stands how many rows each key
has in each slot. A changed row is in its own frame and in those of the next rows of its key. From
the counts follows which slots hold these rows and the ones their frames reach back to, so a
refresh reads those slots, measures their stretches again, and writes the slots of the frames that
changed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from lakeloom.operators.joins import null_safe_on
from lakeloom.operators.merge import latest_per_key
from lakeloom.operators.versioned import merge_table, read_table, version_of
from lakeloom.operators.windows import SLICE_ROWS, trailing
from lakeloom.session import settle, subfolders

_NAME = "__row"

Measures = Callable[[WindowSpec, WindowSpec], dict[str, Column]]


def _counts(spark: SparkSession, path: str, number: int) -> DataFrame:
    """(keys, __slot, __n) as of a version of the table; those of a version that was not finished are made again."""
    if f"version={number}" in subfolders(spark, f"{path}/counts"):
        return spark.read.parquet(f"{path}/counts/version={number}")
    raise LookupError(f"the counts of version {number} are missing under {path}")


def _needed(counts: DataFrame, touched: DataFrame, keys: Sequence[str], back: int) -> DataFrame:
    """(keys, __slot, __stretch): slots that hold a touched key's changed rows, the ``back`` rows before and after.

    Slots of a key that follow each other among those it has rows in are one stretch.
    """
    slots = counts.unionByName(touched.withColumn("__n", F.lit(0).cast("long")))
    slots = slots.groupBy(*keys, "__slot").agg(F.sum("__n").alias("__n"))
    ordered = Window.partitionBy(*keys).orderBy("__slot")
    placed = settle(
        slots.withColumn("__upto", F.sum("__n").over(ordered)).withColumn("__place", F.row_number().over(ordered)),
        "slots",
    )
    hit = touched.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__slot").alias("__hit"))
    same_key = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    at = placed.join(hit, [*same_key, F.col("__slot") == F.col("__hit")]).select(
        *[f"__{k}" for k in keys], F.col("__upto").alias("__end"), (F.col("__upto") - F.col("__n")).alias("__begin")
    )
    # rows between a slot and the changed one: none if it is the changed one itself
    between = F.greatest(F.col("__begin") - F.col("__upto"), F.col("__upto") - F.col("__n") - F.col("__end"))
    near = placed.join(at, same_key).where(between < back).select(*keys, "__slot", "__place").distinct()
    number = F.row_number().over(ordered)
    return near.withColumn("__stretch", F.col("__place") - number).drop("__place")


def refresh_trailing(
    changed: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Measures,
    rows: int,
    slot: Column,
    newest_first: Sequence[Column | str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Put late or changed rows into the measured table at ``path``; returns the rows measured anew.

    A row is known by ``keys`` and ``order``, null being a value like any other; of repeats the newest counts.
    ``measures(frame, ordered)`` are those of ``trailing`` over ``rows`` rows, and may also look one
    row back. ``slot`` is a whole number that rises with the order, such as months since a date. Every
    call must name the same keys, order, measures and slot. The first call makes the table.
    """
    spark, path = changed.sparkSession, path.rstrip("/")
    known = [*keys, *order]
    raw = changed.columns
    new = settle(latest_per_key(changed, known, newest_first).withColumn("__slot", slot.cast("int")), "changed")
    current = version_of(spark, f"{path}/table")
    if current is None:
        found = settle(trailing(new.select(*raw), keys, order, measures, rows, slice_rows), "measured")
        counts = new.groupBy(*keys, "__slot").agg(F.count(F.lit(1)).alias("__n"))
    else:
        before = _counts(spark, path, current.number)
        touched = settle(new.select(*keys, "__slot").distinct(), "touched")
        needed = settle(_needed(before, touched, keys, max(rows - 1, 1)), "needed-slots")
        named = sorted(r[0] for r in needed.select("__slot").distinct().collect())  # at most the slots there are
        stored = read_table(spark, f"{path}/table", current.number, named).select(*raw).withColumn("__slot", slot.cast("int"))
        kept = stored.join(new, null_safe_on(stored, new, known), "left_anti")
        both = kept.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
        stretch = needed.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__slot").alias("__at"), "__stretch")
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        inside = both.join(stretch, [*same, F.col("__slot") == F.col("__at")]).select(*raw, "__new", "__slot", "__stretch")

        def with_mark(frame: WindowSpec, ordered: WindowSpec) -> dict[str, Column]:
            return {**measures(frame, ordered), "__hit": F.max("__new").over(frame)}

        measured = settle(trailing(inside, [*keys, "__stretch"], order, with_mark, max(rows, 2), slice_rows), "measured")
        found = measured.where("__hit = 1").drop("__new", "__hit", "__slot", "__stretch")
        # only rows that were not there before are more
        again = new.join(stored, null_safe_on(new, stored, known), "left_anti")
        more = again.groupBy(*keys, "__slot").agg(F.count(F.lit(1)).alias("__n"))
        counts = before.unionByName(more).groupBy(*keys, "__slot").agg(F.sum("__n").alias("__n"))
    number = 1 if current is None else current.number + 1
    # counts of a version that never comes are written over by the next attempt at it
    counts.write.mode("overwrite").parquet(f"{path}/counts/version={number}")
    # one column that is never null names a row, so that rows of no key are replaced like others
    named = found.withColumn(_NAME, F.struct(*known))
    version = merge_table(named, f"{path}/table", [_NAME], [F.lit(0)], slot=slot)
    if version.number != number:
        raise RuntimeError(f"{path} changed during the refresh")
    return found


def read_trailing(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their measures."""
    return read_table(spark, f"{path.rstrip('/')}/table").drop(_NAME)
