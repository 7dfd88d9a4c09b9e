"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Tables:
    """The given tables of one directory; reading is lazy and pruned by Catalyst."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")


Plan = Callable[[Tables], DataFrame]

PLANS: dict[str, Plan] = {}
CHECKED_BY: dict[str, str] = {}
#: named SQL that other SQL may select from, in order of definition
PIECES: dict[str, str] = {}


def piece(name: str, sql: str) -> str:
    PIECES[name] = sql
    return name


def with_pieces(sql: str) -> str:
    """Prepend the pieces that the SQL reads, directly or through others."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\w+", text)) & PIECES.keys() - wanted:
            wanted.add(word)
            visit(PIECES[word])

    visit(sql)
    if not wanted:
        return sql
    ctes = ",\n".join(f"{name} AS ({PIECES[name]})" for name in PIECES if name in wanted)
    return f"WITH {ctes}\n{sql}"


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"{name} is registered twice")
        PLANS[name] = plan
        if sql is not None:
            CHECKED_BY[name] = with_pieces(sql)
        return plan

    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text and decimals as doubles, so that engines can be compared."""

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        match field.dataType:
            case T.DateType():
                column = F.date_format(column, "yyyy-MM-dd")
            case T.TimestampType() | T.TimestampNTZType():
                column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
            case T.DecimalType():
                column = column.cast("double")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


def runnable(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(plan(Tables(spark, directory)))

    return run


def six(column) -> F.Column:
    """Six decimals: sums of doubles differ in their last digits with the order of adding."""
    return F.floor(column * 1e6 + 0.5) / 1e6


def six_sql(expression: str) -> str:
    return f"floor(({expression}) * CAST(1e6 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1e6 AS DOUBLE)"


def key_sql(*columns: str) -> str:
    parts = ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns
    )
    return f"md5(concat_ws('-', {parts}))"


def day_sql(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def time_sql(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"
