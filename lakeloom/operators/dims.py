"""Dimensions, key bridges and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import fixed_values as V


def dimension(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct combinations of the columns (one partial and one final hash aggregate)."""
    return df.select(*cols).distinct()


def key_bridge(df: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """Distinct keys that are present."""
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias(alias or key)).distinct()


def calendar_columns(day: Column | str) -> list[Column]:
    """Calendar attributes of a date column; Sunday is day 0 of the week."""
    d = F.col(day) if isinstance(day, str) else day
    weekday = F.dayofweek(d) - 1
    return [
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("weekday_name"),
        weekday.cast("bigint").alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        F.quarter(d).cast("bigint").alias("quarter"),
    ]


def days_between(bounds: DataFrame, first: str, last: str, alias: str = "date_col") -> DataFrame:
    """One row per day of each (first, last) range of ``bounds``, both ends included."""
    step = F.expr("INTERVAL '1' DAY")
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last), step)).alias(alias))


def calendar(
    spark: SparkSession, first: str = V.CALENDAR_FIRST, last: str = V.CALENDAR_LAST
) -> DataFrame:
    """The calendar dimension: one row per day with its attributes."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return days_between(bounds, "first", "last").select("date_col", *calendar_columns("date_col"))
