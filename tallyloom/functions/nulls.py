"""Missing-value rules of manifests: null, empty string and zero are missing; comparisons never give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_truthy(*columns: Column) -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def is_in(column: Column, *values: object) -> Column:
    """Membership; false for null."""
    return F.coalesce(column.isin(*values), F.lit(False))


def differs(a: Column, b: Column) -> Column:
    """Inequality in which null is a value."""
    return ~a.eqNullSafe(b)


def truthy(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def int_or_zero(text: Column) -> Column:
    """A whole number, or 0 where the text is missing or is none."""
    return F.coalesce(text.try_cast("int"), F.lit(0))
