"""Window measures that do not put a whole key into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from lakeloom.functions.columns import content_hash, round_money
from lakeloom.session import settle


def price_profile(df: DataFrame, stock: str, price: str, time: str, row_id: str) -> DataFrame:
    """One row per stock: spread, first price and way to the last in (time, id) order, ids counted.

    Rows without a time come last, as they do in the order the measures are defined over.

    Two passes over narrow columns. The first takes plain minima and maxima, which hash
    aggregation holds in place; ordering by (time, id) there would need sorting. The second
    only keeps the rows at the first and the last time of their stock, and orders those.
    """
    bounds = settle(
        df.groupBy(F.col(stock).alias("__stock")).agg(
            F.max(price).alias("__high"),
            F.min(price).alias("__low"),
            F.count(row_id).alias("entries"),
            F.min(time).alias("__first"),
            F.when(F.count_if(F.col(time).isNull()) == 0, F.max(time)).alias("__last"),
        ),
        "price-bounds",
    )
    edges = bounds.select("__stock", F.explode(F.array("__first", "__last")).alias("__time")).distinct()
    at_edge = F.col(stock).eqNullSafe(F.col("__stock")) & F.col(time).eqNullSafe(F.col("__time"))
    order = F.struct(F.col(time).isNull(), F.col(time), F.col(row_id).isNull(), F.col(row_id))
    ends = (
        df.join(edges, at_edge, "left_semi")
        .groupBy(F.col(stock).alias("__ticker"))
        .agg(F.min_by(price, order).alias("first_price"), F.max_by(price, order).alias("last_price"))
    )
    return bounds.join(ends, F.col("__stock").eqNullSafe(F.col("__ticker")), "left").select(
        F.col("__stock").alias(stock),
        round_money(F.col("__high") - F.col("__low")).alias("spread"),
        round_money(F.col("last_price") - F.col("first_price")).alias("first_to_last"),
        "first_price",
        "entries",
    )


def price_movement(
    df: DataFrame,
    stock: str = "stock",
    price: str = "price",
    time: str = "datetime",
    row_id: str = "id",
    profile: DataFrame | None = None,
) -> DataFrame:
    """Price spread, movement since the first price, first-to-last movement, entry count.

    All four are functions of the row's own price and of one small row per stock. The profile
    is aggregated with map-side partials and settled; the ticks then join it without ever being
    gathered by stock, so one stock may hold most of them.
    """
    if profile is None:
        profile = settle(price_profile(df, stock, price, time, row_id), "price-profile")
    stats = profile.withColumnRenamed(stock, "__stock")
    joined = df.join(stats, F.col(stock).eqNullSafe(F.col("__stock")), "left")
    return joined.select(
        *[df[c] for c in df.columns],
        F.col("spread").alias("price_spread"),
        round_money(F.col(price) - F.col("first_price")).alias("relative_price_movement"),
        F.col("first_to_last").alias("abs_price_movement"),
        F.col("entries").alias("num_stock_entries"),
    )


#: Rows of the sorted table that one slice of a trailing window holds.
SLICE_ROWS = 100_000


def _inline(spark: SparkSession, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """A few numbers as a table that is part of the plan."""
    values = ", ".join(f"({a}L, {b}L)" for a, b in pairs) or "(-1L, 0L)"
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(__part, __base)")


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Callable[[WindowSpec, WindowSpec], dict[str, Column]],
    rows: int,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Row-based trailing window whose tasks hold slices of rows, however large a key is.

    The table is range-sorted by key and order and its rows are numbered. Slices are equally many
    consecutive rows; the last ``rows - 1`` of each are handed to the next slice too, so every
    frame sees exactly the rows it would see in a window over the whole key. The plan is the same
    at every size. Rows without an order value come last; a content hash completes the order, so
    ties give the same result on every run.

    ``measures(frame, ordered)`` gets the trailing frame and the plain ordered window (for
    ``lag``) and returns the new columns.
    """
    back = rows - 1
    if slice_rows <= back:
        raise ValueError("a slice must be longer than the window")
    ordering = [*(F.asc(k) for k in keys), *(F.asc_nulls_last(c) for c in order), content_hash(df).asc()]
    numbered = settle(
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("__id", F.monotonically_increasing_id()),
        "sorted",
    )
    # the upper bits of the id are the partition; one number for each goes to the driver
    part = F.shiftright("__id", 33)
    before, total = [], 0
    for number, count in sorted(tuple(r) for r in numbered.groupBy(part.alias("__part")).count().collect()):
        before.append((number, total))
        total += count
    bases = _inline(df.sparkSession, before)
    place = F.col("__base") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    placed = numbered.withColumn("__part", part).join(bases, "__part").withColumn("__place", place)
    own = F.floor(F.col("__place") / slice_rows)
    last = F.col("__place") % slice_rows >= slice_rows - back
    sliced = placed.withColumn("__slice", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))))
    ordered = Window.partitionBy("__slice", *keys).orderBy("__place")
    measured = sliced.withColumns(measures(ordered.rowsBetween(-back, 0), ordered))
    return measured.where(F.col("__slice") == own).drop("__id", "__part", "__base", "__place", "__slice")
