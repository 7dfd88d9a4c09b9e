"""Joins and groupings that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def anti_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], repeated: bool = False
) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right`` (NOT EXISTS).

    A row with a null in its key never matches, so it always passes; such rows are set apart and
    are not shuffled at all. Set ``repeated`` if ``right`` may hold a key many times: its keys are
    then made distinct before the join.
    """
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    seen = right.select(*keys).dropna()
    if repeated:
        seen = seen.distinct()  # grouped by the join keys, so the join needs no other shuffle
    return left.where(~no_key).join(seen, list(keys), "left_anti").select(*left.columns).union(left.where(no_key))


def grouped_counts(
    df: DataFrame, group_cols: Sequence[str], count_col: str, alias: str = "Num_Records"
) -> DataFrame:
    """Non-null count of one column per group."""
    return df.groupBy(*group_cols).agg(F.count(count_col).alias(alias))


def attach_counts(
    parents: DataFrame, children: DataFrame, key: str, count_col: str, alias: str
) -> DataFrame:
    """Left join of parents with the number of their children; childless parents get null.

    Children are counted before the join (partial sums on the map side), so a parent with very
    many children reaches the join as one row.
    """
    return parents.join(grouped_counts(children, [key], count_col, alias), key, "left")


def lookup(facts: DataFrame, table: DataFrame, key: str, other: str | None = None) -> DataFrame:
    """Left join with a lookup; facts keep their rows, several matches fan out.

    The facts are the side that may be skewed. As the left side of an outer join AQE may split
    their hot partitions, and it broadcasts the lookup if that is measured to be small.
    """
    other = other or key
    if other == key:
        return facts.join(table, key, "left")
    return facts.join(table, F.col(key) == F.col(other), "left").drop(other)
