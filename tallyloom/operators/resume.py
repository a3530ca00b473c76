"""Keyed, resumable relations: enrichment, anti-join, upsert, last-wins, row merge and set reconciliation.

All joins are equi-joins on the key; sizes decide at run time whether a side is broadcast, and skewed keys are split by the adaptive planner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the last in the given (total) order."""
    w = Window.partitionBy(*keys).orderBy(*(c.desc() for c in order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def enriched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows, all of them, with the columns of the right row of their key (unique), or nulls."""
    return left.join(right, keys, "left")


def pending(source: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is not done."""
    return source.join(done.select(*keys), keys, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows whose key is not in new, and all new rows."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def merged(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Row merge: a column that both have comes from the right, even where it is null; with how="left" rows without a partner keep theirs."""
    both = [c for c in right.columns if c in left.columns and c not in keys]
    r = right.select(*keys, F.struct(*(c for c in right.columns if c not in keys)).alias("_r"), F.lit(True).alias("_hit"))
    out = left.join(r, keys, how)
    hit = F.coalesce("_hit", F.lit(False))
    own = [F.when(hit, F.col(f"_r.{c}")).otherwise(F.col(c)).alias(c) if c in both else F.col(c) for c in left.columns]
    return out.select(*own, *(F.col(f"_r.{c}").alias(c) for c in right.columns if c not in left.columns))


def reconciled(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with status missing, extra or matched."""
    e, a = (d.select(*keys).distinct().withColumn(n, F.lit(True)) for d, n in ((expected, "_e"), (actual, "_a")))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra").otherwise("matched")
    return e.join(a, keys, "full").select(*keys, status.alias("status"))


def orphans(present: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    return present.join(wanted.select(*keys), keys, "left_anti")


def first_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in a total order; a negative n is 0."""
    return df.orderBy(*order).limit(max(0, n))


def reused(work: DataFrame, prior: DataFrame, keys: list[str], status: str, done: str = "complete") -> DataFrame:
    """Work rows with the columns of the prior result of their key where that is finished, else nulls, and to_do: whether a row has none. Prior rows are unique by key; those that aren't finished count as none."""
    fields = [c for c in prior.columns if c not in keys]
    own = prior.where(F.col(status) == done).select(*keys, *fields, F.lit(True).alias("_done"))
    return work.drop(*fields).join(own, keys, "left").withColumn("to_do", F.col("_done").isNull()).drop("_done")
