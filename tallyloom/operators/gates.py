"""Ordered gates: the first that fails gives the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failure(gates: list[tuple[Column, str]]) -> Column:
    """Reason of the first gate whose condition holds, else null. A null condition doesn't hold."""
    out = None
    for fails, reason in gates:
        out = F.when(fails, F.lit(reason)) if out is None else out.when(fails, F.lit(reason))
    return out


def routed(df: DataFrame, arms: list[tuple[Column, str]], default: str, name: str = "route") -> DataFrame:
    """Priority cascade: each row goes to the first arm whose condition holds."""
    return df.withColumn(name, F.coalesce(first_failure(arms), F.lit(default)))


def report(df: DataFrame, by: str, *conditions: tuple[str, Column]) -> DataFrame:
    """One row of counts: all rows and those of each condition."""
    return df.agg(F.count("*").alias(by), *(F.count_if(c).alias(n) for n, c in conditions))


@dataclass(frozen=True)
class StageResult:
    """What a stage returns to its caller: whether its gate holds, and its counters."""

    ok: bool
    report: dict


def result(report_row: DataFrame, ok: Column) -> StageResult:
    row = report_row.withColumn("_ok", ok).first().asDict()
    return StageResult(bool(row.pop("_ok")), row)


def counted(df: DataFrame, column: str) -> DataFrame:
    """Rows by value, missing values as the empty string."""
    return df.groupBy(F.coalesce(column, F.lit("")).alias(column)).agg(F.count("*").alias("n_rows"))


def expect_rows(df: DataFrame, n: int) -> DataFrame:
    """df, or an error if it hasn't n rows."""
    if (found := df.count()) != n:
        raise ValueError(f"{found} rows where {n} are expected")
    return df
