"""Ordered selections of the items of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: selections that are worked out from one row
RANGE = 4096


def _places(later: int) -> list[tuple[str, Column]]:
    """Steps, each a name and its column, from ``__number`` to the places ``__p1``, ``__p2`` ... of the later items.

    The number is read in the base of what is left to choose from (n - 1, n - 2 and so on), the last
    digit first. A digit counts among the places not chosen yet, so it moves up by one for each chosen
    place that is not above it, the chosen ones taken in order. Beyond the size of a group: null.
    """
    steps = [("__rest", F.col("__number"))]
    for depth in range(later, 0, -1):
        there = F.col("__n") > depth
        steps.append((f"__d{depth}", F.when(there, F.expr(f"__rest % (__n - {depth})"))))
        steps.append(("__rest", F.when(there, F.expr(f"__rest div (__n - {depth})")).otherwise(F.col("__rest"))))
    for depth in range(1, later + 1):
        chosen = F.array_sort(F.array(F.col("__place"), *[F.col(f"__p{d}") for d in range(1, depth)]))
        moved = F.aggregate(chosen, F.col(f"__d{depth}"), lambda at, taken: at + (taken <= at).cast("long"))
        steps.append((f"__p{depth}", moved))
    return steps


def ordered_selections(
    df: DataFrame,
    key: str,
    item: str,
    names: Sequence[str],
    attrs: Sequence[str] = (),
    spread: int | None = None,
    selections: int = RANGE,
) -> DataFrame:
    """Each row followed by every ordered selection of different items of its key.

    The same bag as left joining the table ``len(names) - 1`` times to itself on ``key`` with
    "item not in (items before)": once a level finds nothing, all later levels are null.
    Requires (key, item) to be unique, as the chained joins would multiply duplicates.

    ``names`` are the output columns of the levels; ``attrs`` are columns of the first row that
    are carried along. The selections behind a row are numbered: of n items there are (n - 1)(n - 2)...
    Ranges of ``selections`` numbers are dealt to the tasks, and each number is decoded into its
    selection, so there are no self joins and no levels, and a big group is worked out by all tasks
    evenly. The number of rows out is given by the operator itself; what a key's rows carry is
    the list of its items.
    """
    first, *later = names
    # Rows without a key or an item match nothing. They skip the grouping, so that many of
    # them never meet in one task.
    alone = F.col(key).isNull() | F.col(item).isNull()
    item_type = df.schema[item].dataType
    singles = df.where(alone).select(
        key, *attrs, F.col(item).alias(first), *[F.lit(None).cast(item_type).alias(n) for n in later]
    )

    in_order = Window.partitionBy(key).orderBy(item)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # columns get names of their own, as the output names may be those of the input
    own = [F.col(c).alias(f"__a{i}") for i, c in enumerate(attrs)]
    numbered = df.where(~alone).select(
        F.col(key).alias("__key"),
        *own,
        (F.row_number().over(in_order) - 1).cast("long").alias("__place"),
        F.collect_list(item).over(whole).alias("__items"),
    )
    counted = numbered.withColumn("__n", F.size("__items").cast("long"))
    many = F.lit(1).cast("long")
    for depth in range(1, len(later) + 1):
        many = many * F.greatest(F.col("__n") - depth, F.lit(1))
    starts = F.sequence(F.lit(0).cast("long"), F.col("__many") - 1, F.lit(selections).cast("long"))
    ranges = counted.withColumn("__many", many).withColumn("__from", F.explode(starts))
    parts = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.repartition(parts, "__key", "__place", "__from")
    upto = F.least(F.col("__from") + selections, F.col("__many")) - 1
    each = dealt.withColumn("__number", F.explode(F.sequence("__from", upto)))
    for name, column in _places(len(later)):
        each = each.withColumn(name, column)
    found = each.select(
        F.col("__key").alias(key),
        *[F.col(f"__a{i}").alias(c) for i, c in enumerate(attrs)],
        *[F.get("__items", F.col(p).cast("int")).alias(n) for p, n in zip(["__place", *[f"__p{d}" for d in range(1, len(names))]], names)],
    )
    return found.unionByName(singles)
