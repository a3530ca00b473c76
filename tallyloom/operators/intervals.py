"""Interval algebra over rows (keyed, by windows) and within rows (arrays of struct start, end)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators import scans


def _islands(df: DataFrame, keys: list[str], tolerance: float, n: Column, width: float | None) -> DataFrame:
    """keys, start, end, n (summed up) of what belongs together; with width each key's bucket by itself, so islands of one bucket aren't joined to those of another."""
    own = [*keys, "_step"] if width is not None else keys
    rows = df.withColumn("_step", scans.bucket("start", width)) if width is not None else df
    order = Window.partitionBy(*own).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach + tolerance), 1).otherwise(0))
    island = opened.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*own, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum(n).alias("n_merged")).drop("_island", "_step")


def merged_intervals(df: DataFrame, keys: list[str], tolerance: float = 0, width: float | None = None) -> DataFrame:
    """Intervals (start, end) of each key merged where the next starts no later than tolerance after the furthest end so far: keys, start, end, n_merged.

    Without width a key is sorted in one task. With it, a key's rows are merged within buckets of that width by start; the islands that are left are scanned over buckets, with the furthest end and the number of islands before carried into each, and merged where they touch: a hot key is many tasks, and the result is the same.
    """
    if width is None:
        return _islands(df, keys, tolerance, F.lit(1), None)
    rows = _islands(df, keys, tolerance, F.lit(1), width).withColumn("_step", scans.bucket("start", width))
    order = Window.partitionBy(*keys, "_step").orderBy("start", "end")
    inner = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    far = scans.carried(rows, keys, "_step", {"_far": ("end", F.max)})
    reach = F.greatest(inner, "_far")
    opened = far.withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach + tolerance), 1).otherwise(0))
    numbered = scans.carried(opened, keys, "_step", {"_before": ("_new", F.sum)})
    island = F.coalesce("_before", F.lit(0)) + F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return numbered.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_merged").alias("n_merged")).drop("_island")


def subtracted(keep: DataFrame, cut: DataFrame, keys: list[str], tolerance: float = 0, width: float | None = None) -> DataFrame:
    """What is in the merged intervals of keep but in none of cut: a sweep over the ends of both. width: as in merged_intervals; the sums of ends before a bucket and the next end after it are carried into it."""
    k, c = merged_intervals(keep, keys, tolerance, width), merged_intervals(cut, keys, tolerance, width)

    def ends(d: DataFrame, own: str, other: str) -> DataFrame:
        on = F.explode(F.array(F.struct(F.col("start").alias("_mark"), F.lit(1).alias(own)), F.struct(F.col("end").alias("_mark"), F.lit(-1).alias(own)))).alias("_e")
        return d.select(*keys, on).select(*keys, "_e.*", F.lit(0).alias(other))

    marks = ends(k, "_keep", "_cut").unionByName(ends(c, "_cut", "_keep")).groupBy(*keys, "_mark").agg(F.sum("_keep").alias("_keep"), F.sum("_cut").alias("_cut"))
    own, none = keys, F.lit(0)
    before, after = {"_k": none, "_c": none}, F.lit(None)
    if width is not None:
        marks = scans.carried(marks.withColumn("_step", scans.bucket("_mark", width)), keys, "_step", {"_k": ("_keep", F.sum), "_c": ("_cut", F.sum)}, {"_after": ("_mark", F.min)})
        own, before, after = [*keys, "_step"], {n: F.coalesce(n, none) for n in before}, F.col("_after")
    order = Window.partitionBy(*own).orderBy("_mark")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    inside = (before["_k"] + F.sum("_keep").over(upto) > 0) & (before["_c"] + F.sum("_cut").over(upto) == 0)
    swept = marks.withColumns({"_in": inside, "end": F.coalesce(F.lead("_mark").over(order), after)})
    pieces = swept.where(F.col("_in") & F.col("end").isNotNull()).select(*keys, F.col("_mark").alias("start"), "end")
    # neighbouring pieces that a mark of the cut alone parted (an empty cut) are one again
    return merged_intervals(pieces, keys, 0, width).drop("n_merged")


def longest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The longest interval of each key, the earliest of equals."""
    best = F.max(F.struct((F.col("end") - F.col("start")).alias("length"), (-F.col("start")).alias("early"), "start", "end"))
    return df.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.start", "b.end")


def merge_array(intervals: Column, tolerance: float = 0.1) -> Column:
    """Merged intervals of an array of struct start, end."""
    kind = "array<struct<start:double,end:double>>"
    ordered = F.array_sort(F.transform(intervals, lambda x: F.struct(x["start"].cast("double").alias("start"), x["end"].cast("double").alias("end"))))

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (x["start"] <= last["end"] + tolerance), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(ordered, F.array().cast(kind), step)


def subtract_array(keep: Column, cuts: Column) -> Column:
    """Parts of the intervals that no cut touches; edges that only meet don't cut."""

    def without(acc: Column, c: Column) -> Column:
        def split(x: Column) -> Column:
            before = F.struct(x["start"].alias("start"), F.least(x["end"], c["start"]).alias("end"))
            after = F.struct(F.greatest(x["start"], c["end"]).alias("start"), x["end"].alias("end"))
            meet = (c["start"] < x["end"]) & (c["end"] > x["start"])
            return F.when(meet, F.filter(F.array(before, after), lambda p: p["end"] > p["start"])).otherwise(F.array(x))

        return F.flatten(F.transform(acc, split))

    return F.aggregate(cuts, keep, without)


def clean_runs(accepted: Column, rejected: Column, minimum: float = 50.0, tolerance: float = 0.1) -> Column:
    """Merged accepted intervals without the merged rejected ones, of the minimum length or more."""
    return F.filter(subtract_array(merge_array(accepted, tolerance), merge_array(rejected, tolerance)), lambda x: x["end"] - x["start"] >= minimum)


def chunked(df: DataFrame, duration: str, stride: int = 25, length: int = 30, tail: int = 10) -> DataFrame:
    """A row for each overlapping chunk: chunk_index, chunk_start, chunk_end. Chunks start while the start is before duration - tail."""
    d = F.col(duration)
    n = F.ceil((d - tail) / stride).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1))
    out = df.withColumn("chunk_index", F.explode(starts))
    return out.withColumn("chunk_start", F.col("chunk_index") * stride).withColumn("chunk_end", F.least(d, F.col("chunk_start") + length))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def best_window(duration: Column, downbeats: Column, sections: Column, weight, longest_: float, shortest: float = 60.0) -> Column:
    """struct(score, length, early, start, end) of the best window between downbeats, within one row.

    Whole if the duration is no more than the longest; else for each start (0 or a downbeat) the furthest end (a downbeat or the end) with a length of shortest to longest; the best has the highest sum of overlap times weight of the sections (struct label, start, end), then the greatest length, then the earliest start. Null without downbeats or a window.
    """
    beats = F.array_sort(F.array_distinct(F.filter(downbeats, lambda b: b.between(F.lit(0), duration))))
    starts, ends = F.array_distinct(F.concat(F.array(F.lit(0.0)), beats)), F.array_distinct(F.concat(beats, F.array(duration.cast("double"))))

    def window(s: Column) -> Column:
        e = F.array_max(F.filter(ends, lambda x: (x - s >= shortest) & (x - s <= longest_ + 1e-6)))
        score = F.aggregate(sections, F.lit(0.0), lambda acc, x: acc + overlap(s, e, x["start"], x["end"]) * weight(x["label"]))
        return F.when(e.isNotNull(), F.struct(score.alias("score"), (e - s).alias("length"), (-s).alias("early"), s.alias("start"), e.alias("end")))

    picked = F.array_max(F.filter(F.transform(starts, window), lambda x: x.isNotNull()))
    whole = F.struct(F.lit(None).cast("double").alias("score"), duration.cast("double").alias("length"), F.lit(0.0).alias("early"), F.lit(0.0).alias("start"), duration.cast("double").alias("end"))
    return F.when(duration <= longest_, whole).when(F.size(beats) > 0, picked)


def next_within(df: DataFrame, keys: list[str], at: str, target, reach: float, name: str, width: float | None = None) -> DataFrame:
    """df with name: the first time (column at) of a target row (a condition) of the key at or after the row's own and no more than reach later, else null. A key's rows are sorted, never collected: in one task, or with width bucket by bucket, into which the first target time of later buckets is carried.

    Rows are scanned from the latest to the earliest, so a row costs one step: a frame that ends with its partition, or slides, is gone through anew for every row.
    """
    when = F.when(target, F.col(at))
    first = lambda *own: F.min("_when").over(Window.partitionBy(*own).orderBy(F.col(at).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    if width is None:
        rows, seen = df.withColumn("_when", when), first(*keys)
    else:
        rows = scans.carried(df.withColumn("_step", scans.bucket(at, width)).withColumn("_when", when), keys, "_step", after={"_later": ("_when", F.min)})
        seen = F.coalesce(first(*keys, "_step"), "_later")
    found = rows.withColumn("_seen", seen)
    return found.withColumn(name, F.when(F.col("_seen") <= F.col(at) + reach, F.col("_seen"))).drop("_step", "_when", "_later", "_seen")


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str, width: int = 256) -> DataFrame:
    """df with name: each row's number (from 1) within its key in a total order whose first column is numeric. Numbers are made within steps of width of that column and added to the rows of the steps before, so a hot key is no one task's."""
    rows = df.withColumn("_step", F.floor(F.col(order[0]) / width))
    sums = rows.groupBy(*keys, "_step").agg(F.count("*").alias("_n"))
    before = sums.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_step").alias("_s"), F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_step").eqNullSafe(F.col("_s"))]
    own = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*keys, "_step").orderBy(*order)))
    return own.join(before, on).withColumn(name, (F.col("_before") + F.col("_i")).cast("long")).drop("_step", "_s", "_i", "_before", *(f"_k_{k}" for k in keys))
