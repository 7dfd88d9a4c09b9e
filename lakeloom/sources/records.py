"""CSV records whose quoted fields may hold line breaks, from files that many tasks read.

A file is read in pieces, so a piece may begin inside a quoted field. What a line does to the state
"inside quotes" is one of four maps: keep it, flip it, set it, clear it. The maps of a piece's
lines compose into one of the same four, so one short row per piece, and a prefix over the pieces of a
file, tells how each piece begins; only then are lines joined into records. Lines without a
quote keep the state, and pieces that begin outside quotes and hold no quote pass as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.session import settle
from lakeloom.sources.landing import _FIELD, csv_metrics, csv_rows

#: a quoted field that is closed, whatever stands behind the closing quote
_CLOSED = r'(?s)^"[^"]*+(?:""[^"]*+)*+"'


def _left_open(line: Column) -> Column:
    """Whether a record that begins with this line goes on in the next: its last field is quoted and not closed."""
    last = F.element_at(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1)), -1)
    return last.startswith('"') & ~last.rlike(_CLOSED)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, piece, id, value, outside, inside): each line and how it ends, begun outside and inside quotes."""
    found = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("id"),
    )
    quoted = F.col("value").contains('"')
    return found.withColumns(
        {
            "outside": quoted & _left_open(F.col("value")),
            "inside": ~quoted | _left_open(F.concat(F.lit('"'), F.col("value"))),
        }
    )


def _state(rows: DataFrame, by: Sequence[str], order: str, name: str) -> DataFrame:
    """``rows`` with the map of all rows of a group up to and with each one: ``<name>_outside``, ``<name>_inside``.

    The last map that sets or clears decides, and the flips behind it.
    """
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sets = F.col("outside") == F.col("inside")
    flips = F.sum((F.col("outside") & ~F.col("inside")).cast("int")).over(upto)
    counted = rows.withColumn("__flips", flips)
    last = F.last(F.when(sets, F.struct("outside", "__flips")), ignorenulls=True).over(upto)
    at = counted.withColumn("__last", last)
    odd = F.pmod(F.col("__flips") - F.coalesce("__last.__flips", F.lit(0)), F.lit(2)) == 1
    settled = F.col("__last.outside")
    return at.withColumns(
        {
            f"{name}_outside": F.coalesce(settled, F.lit(False)) != odd,
            f"{name}_inside": F.coalesce(settled, F.lit(True)) != odd,
        }
    ).drop("__flips", "__last")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per CSV record, line breaks inside quoted fields kept.

    A quote opens a field only at its beginning, and doubled quotes inside are one; so it is the
    same records that a reader of the whole file finds. A field that is never closed runs to the
    end of its file, as it does there, and makes one record of it. Empty lines are records
    without a field.
    """
    lines = settle(_lines(spark, path), "lines")
    turning = lines.where(F.col("outside") | ~F.col("inside")).drop("value")
    ends = _state(turning, ["file", "piece"], "id", "end")
    of_piece = ends.groupBy("file", "piece").agg(
        F.max_by(F.struct("end_outside", "end_inside"), "id").alias("end")
    )
    pieces = lines.groupBy("file", "piece").agg(F.count(F.lit(1)).alias("lines")).join(of_piece, ["file", "piece"], "left")
    maps = pieces.select(
        "file",
        "piece",
        F.col("end").isNotNull().alias("turns"),
        F.coalesce("end.end_outside", F.lit(False)).alias("outside"),
        F.coalesce("end.end_inside", F.lit(True)).alias("inside"),
    )
    # one row a piece of a file
    begins = F.lag("upto_outside", 1, False).over(Window.partitionBy("file").orderBy("piece"))
    begun = settle(
        _state(maps, ["file"], "piece", "upto").withColumn("begins_inside", begins).select("file", "piece", "turns", "begins_inside"),
        "pieces",
    )
    placed = lines.join(begun, ["file", "piece"])
    quiet = placed.where(~F.col("turns") & ~F.col("begins_inside")).select("file", "piece", "id", "value")
    busy = _state(placed.where(F.col("turns") | F.col("begins_inside")), ["file", "piece"], "id", "end")
    after = F.when(F.col("begins_inside"), F.col("end_inside")).otherwise(F.col("end_outside"))
    here = Window.partitionBy("file", "piece").orderBy("id")
    marked = busy.select("file", "piece", "id", "value", "begins_inside", after.alias("after")).withColumn(
        "before", F.lag("after", 1).over(here)
    )
    before = F.coalesce("before", "begins_inside")
    marked = marked.withColumn("before", before)
    whole = marked.where(~F.col("before") & ~F.col("after")).select("file", "piece", "id", "value")
    parts = marked.where(F.col("before") | F.col("after"))
    # parts of records in order: a record begins where the line before it ended outside quotes
    start = F.when(~F.col("before"), F.struct("piece", "id"))
    own = F.last(start, ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0))
    parts = settle(parts.withColumn("start", own), "record-parts")
    # lines that go on a record of an earlier piece take the last start of the pieces before theirs
    last = parts.groupBy("file", "piece").agg(F.max("start").alias("last"))
    earlier = F.last("last", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = last.select("file", "piece", earlier.alias("carried"))
    joined = parts.join(carried, ["file", "piece"]).withColumn("start", F.coalesce("start", "carried"))
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("piece", "id", "value"))), lambda x: x["value"]), "\n"
    )
    records = joined.groupBy("file", "start").agg(text.alias("value"))
    return quiet.select("value").union(whole.select("value")).union(records.select("value"))


def read_csv_records(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    """All-text rows of the records that have as many fields as the header."""
    return csv_rows(read_records(spark, path), header)


def read_csv_record_metrics(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    return csv_metrics(read_records(spark, path), header)
