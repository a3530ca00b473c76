"""Scans over hot keys: running values of a key's rows in order, without sorting the key in one task.

A key's rows are cut into buckets of time. Each bucket is summed up first, the few rows of sums are scanned in order, and what earlier (or later) buckets come to is carried into each bucket, whose rows are then scanned by themselves. Buckets of one key are many tasks; only its sums, a row a bucket, meet in one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Fold = tuple[str | Column, Callable]


def bucket(at: str, width: float) -> Column:
    return F.floor(F.col(at) / F.lit(width))


def carried(rows: DataFrame, keys: list[str], step: str, before: dict[str, Fold] | None = None, after: dict[str, Fold] | None = None) -> DataFrame:
    """rows with a column for each name of before: what its fold (column, aggregate such as F.max) makes of all rows of the key in earlier buckets (column step), and likewise for after and later ones; null where there are none. Null keys are a key, a null step comes first."""
    before, after = before or {}, after or {}
    every = before | after
    sums = rows.groupBy(*keys, step).agg(*(fold(c).alias(f"_sum_{n}") for n, (c, fold) in every.items()))
    # later buckets are those before it in descending order: a frame up to the end of a key is gone through anew for every row
    earlier, later = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col(step).asc_nulls_first(), F.col(step).desc_nulls_last()))
    scan = [every[n][1](f"_sum_{n}").over(w).alias(n) for names, w in ((before, earlier), (after, later)) for n in names]
    named = sums.select(*(F.col(c).alias(f"_of_{c}") for c in (*keys, step)), *scan)
    on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*keys, step)]
    return rows.join(named, on).drop(*(f"_of_{c}" for c in (*keys, step)))
