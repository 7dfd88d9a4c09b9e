"""Declarative checks on tables, and schema contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, types as T
from pyspark.sql import functions as F

from lakeloom.operators.joins import anti_join


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    """No value occurs twice. Several columns are checked as a combination."""

    columns: tuple[str, ...]

    def __init__(self, *columns: str):
        object.__setattr__(self, "columns", columns)


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple


@dataclass(frozen=True)
class Between:
    column: str
    low: float
    high: float


@dataclass(frozen=True)
class Related:
    """Each value that is present exists in ``field`` of the parent table."""

    column: str
    parent: str
    field: str


Check = NotNull | Unique | Accepted | Between | Related

RESULT = ["check", "column", "failures", "status"]


def _bad_row(check: Check) -> tuple[str, Column] | None:
    match check:
        case NotNull(column):
            return "not_null", F.col(column).isNull()
        case Accepted(column, values):
            return "accepted_values", ~F.col(column).isin(list(values))
        case Between(column, low, high):
            return "between", ~F.col(column).between(low, high)
    return None


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks that look at one row at a time, in a single pass over the table."""
    named = [(c.column, *_bad_row(c)) for c in checks]
    totals = df.agg(*[F.count_if(bad).alias(f"__{i}") for i, (_, _, bad) in enumerate(named)])
    lines = [
        F.struct(
            F.lit(name).alias("check"),
            F.lit(column).alias("column"),
            F.col(f"__{i}").alias("failures"),
        )
        for i, (column, name, _) in enumerate(named)
    ]
    return totals.select(F.inline(F.array(*lines)))


def _line(failing: DataFrame, name: str, column: str, failures: Column) -> DataFrame:
    return failing.agg(
        F.lit(name).alias("check"),
        F.lit(column).alias("column"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


def _unique(df: DataFrame, check: Unique) -> DataFrame:
    cols = list(check.columns)
    # A single column is checked where it is present; a combination counts nulls as values.
    rows = df.dropna(subset=cols) if len(cols) == 1 else df
    repeated = rows.groupBy(*cols).count().where(F.col("count") > 1)
    name = "unique" if len(cols) == 1 else "unique_combination"
    return _line(repeated, name, ",".join(cols), F.count(F.lit(1)))


def _related(df: DataFrame, check: Related, parents: Mapping[str, DataFrame]) -> DataFrame:
    # Count per value first: a value with very many rows joins as one row.
    used = df.where(F.col(check.column).isNotNull()).groupBy(F.col(check.column).alias("__fk")).count()
    known = parents[check.parent].select(F.col(check.field).alias("__fk"))
    orphans = anti_join(used, known, ["__fk"], repeated=True)
    return _line(orphans, "relationships", check.column, F.sum("count"))


def run_checks(
    df: DataFrame, checks: Sequence[Check], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row per check: name, column(s), number of failures, pass or fail."""
    per_row = [c for c in checks if _bad_row(c)]
    parts = [_row_checks(df, per_row)] if per_row else []
    for check in checks:
        if isinstance(check, Unique):
            parts.append(_unique(df, check))
        elif isinstance(check, Related):
            parts.append(_related(df, check, parents or {}))
    result = reduce(DataFrame.unionByName, parts)
    return result.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def observed(df: DataFrame, checks: Sequence[Check], where: Column | None = None) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows, and the failures of the checks on one row, while it is written.

    The counts are there once the write is done. ``where`` says which rows the checks look at.
    """
    seen = F.lit(True) if where is None else where
    counts = [F.count_if(_bad_row(c)[1] & seen).alias(f"check_{i}") for i, c in enumerate(checks) if _bad_row(c)]
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("row_count"), *counts), observation


def observed_failures(checks: Sequence[Check], observation: Observation) -> list[tuple[str, str, int]]:
    """(check, column, failures) of the checks on one row, as the write has counted them."""
    found = observation.get
    return [(_bad_row(c)[0], c.column, found[f"check_{i}"]) for i, c in enumerate(checks) if _bad_row(c)]


class ContractError(ValueError):
    pass


def contract_differences(df: DataFrame, contract: T.StructType) -> list[str]:
    """What keeps ``df`` from having exactly the columns and types of the contract."""
    have = {f.name.lower(): f.dataType for f in df.schema}
    want = {f.name.lower(): f.dataType for f in contract}
    missing = [f"missing column {name}" for name in want if name not in have]
    extra = [f"unexpected column {name}" for name in have if name not in want]
    wrong = [
        f"column {name} is {have[name].simpleString()}, not {kind.simpleString()}"
        for name, kind in want.items()
        if name in have and have[name] != kind
    ]
    return missing + extra + wrong


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    differences = contract_differences(df, contract)
    if differences:
        raise ContractError("; ".join(differences))
    return df.select(*contract.names)
