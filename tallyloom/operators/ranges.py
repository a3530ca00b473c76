"""Joins of intervals of two relations, as equi-joins on bins of time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sized(df: DataFrame, width: float, step: int) -> DataFrame:
    """df with its level: the finest whose bins are as long as the interval, so that it covers at most two of them."""
    length = (F.col("end") - F.col("start")).cast("double")
    return df.where(F.col("end") >= F.col("start")).withColumn("_own", F.when(length <= width, 0).otherwise(F.ceil(F.log(length / width) / math.log(step))).cast("int"))


def _bin(at: Column, level: Column, width: float, step: int) -> Column:
    return F.floor(at.cast("double") / (F.lit(float(width)) * F.pow(F.lit(float(step)), level)))


def _binned(df: DataFrame, levels: list[int], width: float, step: int) -> DataFrame:
    """A row for each bin that an interval covers, on its own level and on those of levels that are coarser."""
    every = F.array_union(F.array(F.col("_own")), F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda m: m > F.col("_own")))
    each = df.withColumn("_level", F.explode(every))
    return each.withColumn("_bin", F.explode(F.sequence(_bin(F.col("start"), F.col("_level"), width, step), _bin(F.col("end"), F.col("_level"), width, step))))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], names: tuple[str, str] = ("left_", "right_"), width: float | None = None, step: int = 4) -> DataFrame:
    """Pairs of rows with equal keys whose intervals overlap (start < other end and other start < end): keys, and the other columns of both sides with the prefixes in names.

    An interval lies in the bins of the level whose width (width times a power of step) is at least its length, so a long one is in few coarse bins, not in many fine ones; on the coarser levels that the other side has it is a guest. Both sides meet by an equi-join on key, level and bin, on the coarser of their own levels, and a pair counts in the bin of the later start alone, so no pair comes twice. width is taken from the data if it isn't given: the middle length of both sides (a row a side is collected, and the levels there are). Null keys, null ends and intervals that end before they start meet nothing; empty intervals count where the condition holds.
    """
    if width is None:
        lengths = left.select("start", "end").unionByName(right.select("start", "end")).where("end > start").select((F.col("end") - F.col("start")).cast("double").alias("n"))
        width = lengths.agg(F.percentile_approx("n", 0.5)).first()[0] or 1.0
    a, b = _sized(left, width, step), _sized(right, width, step)
    level = [sorted(r[0] for r in df.select("_own").distinct().collect()) for df in (a, b)]
    a, b = _binned(a, level[1], width, step), _binned(b, level[0], width, step)
    here = ["_own", "_level", "_bin"]
    a, b = ((df.select(*(F.col(c).alias(c if c in keys else f"{p}{c}") for c in df.columns if c not in ("_level", "_bin")), "_level", "_bin")) for df, p in ((a, names[0]), (b, names[1])))
    x, y = names
    both = a.join(b, [*keys, "_level", "_bin"])
    later = F.greatest(F.col(f"{x}start"), F.col(f"{y}start"))
    first = (F.greatest(f"{x}_own", f"{y}_own") == F.col("_level")) & (_bin(later, F.col("_level"), width, step) == F.col("_bin"))
    meet = (F.col(f"{x}start") < F.col(f"{y}end")) & (F.col(f"{y}start") < F.col(f"{x}end"))
    return both.where(first & meet).drop(*here[1:], f"{x}_own", f"{y}_own")
