"""Ordered folds: greedy balancing, early stopping, group-safe splits, means of means.

Folds whose every step depends on the one before run per group over Arrow tables (one pass, rows carried as they are): groups are batches or training runs, of a bounded size.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.nulls import first_truthy


def _schema(df: DataFrame, more: str) -> T.StructType:
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])


def balanced(df: DataFrame, group: list[str], weight: str, order: str, parts: int = 2) -> DataFrame:
    """Parts of each group: heaviest first (ties in the order given), each row to the part with the least load so far, the first of equals. Adds part (0, 1, ...).

    Rows are carried, so repeated rows stay as many as they are; rows with a null group are a group; a null weight counts as 0. Each choice depends on all before it, so a group is folded in one task.
    """
    if parts < 1:
        raise ValueError(f"parts must be 1 or more, not {parts}")

    def fold(table: pa.Table) -> pa.Table:
        load = [0] * parts
        weights = pc.fill_null(table[weight], 0)
        at = pc.sort_indices(pa.table({"w": weights, "o": table[order]}), sort_keys=[("w", "descending"), ("o", "ascending")])
        out = []
        for w in weights.take(at).to_pylist():
            part = load.index(min(load))
            load[part] += w
            out.append(part)
        return table.take(at).append_column("part", pa.array(out, pa.int32()))

    rows = df.drop("part")
    return rows.groupBy(*group).applyInArrow(fold, _schema(rows, "part int"))


#: State of a tracker that has seen no check yet.
FRESH = (float("inf"), 0, 0)


def tracked(df: DataFrame, group: list[str], step: str, loss: str, every: int = 1, patience: int = 0, margin: float = 1e-8, state: DataFrame | None = None) -> DataFrame:
    """Validation state after each check of a group: best_loss, best_step, stale, stop. A loss improves only if it is below the best by more than the margin; checks are the steps divisible by every; stop once stale reaches patience (if any).

    state: rows (group, best_loss, best_step, stale) to go on from, unique by group; groups without one start afresh. The last row of a group, given back as state, goes on as if there had been no break. A missing loss is no improvement.
    """
    if every < 1 or patience < 0:
        raise ValueError(f"every must be 1 or more and patience 0 or more, not {every} and {patience}")
    checks = df.where(F.pmod(F.col(step), F.lit(every)) == 0).select(*group, F.col(step).cast("bigint").alias(step), F.col(loss).cast("double").alias(loss))
    from_ = ["_best_loss", "_best_step", "_stale"]
    if state is None:
        checks = checks.withColumns({n: F.lit(v).cast(t) for n, v, t in zip(from_, FRESH, ("double", "bigint", "int"), strict=True)})
    else:
        known = state.select(*(F.col(c).alias(f"_g_{c}") for c in group), *(F.col(n[1:]).alias(n) for n in from_))
        on = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group]
        checks = checks.join(known, on, "left").withColumns({n: F.coalesce(F.col(n), F.lit(v)).cast(t) for n, v, t in zip(from_, FRESH, ("double", "bigint", "int"), strict=True)}).drop(*(f"_g_{c}" for c in group))

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by(step)
        best, at, stale = (table[n][0].as_py() for n in from_)
        out = []
        for s, x in zip(table[step].to_pylist(), table[loss].to_pylist(), strict=True):
            better = x is not None and x < best - margin
            best, at, stale = (x, s, 0) if better else (best, at, stale + 1)
            out.append((best, at, stale))
        columns = zip(*out, strict=True)
        kept = table.select([*group, step, loss])
        for name, kind, values in zip(("best_loss", "best_step", "stale"), (pa.float64(), pa.int64(), pa.int32()), columns, strict=True):
            kept = kept.append_column(name, pa.array(values, kind))
        return kept

    own = checks.select(*group, step, loss)
    out = checks.groupBy(*group).applyInArrow(fold, _schema(own, "best_loss double, best_step bigint, stale int"))
    return out.withColumn("stop", F.lit(patience > 0) & (F.col("stale") >= patience))


def group_split(df: DataFrame, group: str | list[str], ratio: float, seed: int = 42) -> DataFrame:
    """Adds split: whole groups go to validation, in the order of a hash of seed and group, while fewer rows than round(n * ratio) are there; the rest is train.

    group: a column, or several of which the first that is neither null nor empty names a row's group; rows without any are one group. The order is cut at the group that reaches the target. Groups are summed per prefix of their hash first, so the running sum over groups runs within a prefix and only the few prefixes are ordered in one task.
    """
    if not 0 <= ratio <= 1:
        raise ValueError(f"ratio must be within 0 and 1, not {ratio}")
    names = [group] if isinstance(group, str) else group
    key = first_truthy(*(F.col(c).cast("string") for c in names)) if len(names) > 1 else F.col(names[0]).cast("string")
    rows = df.drop("split").withColumn("_g", F.coalesce(key, F.lit("")))
    sizes = rows.groupBy("_g").agg(F.count("*").alias("_n")).withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}|"), F.col("_g")), 256)).withColumn("_p", F.substring("_h", 1, 3))
    target = round(df.count() * ratio)  # half to even
    prefixes = sizes.groupBy("_p").agg(F.sum("_n").alias("_s"))
    before = prefixes.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    inner = Window.partitionBy("_p").orderBy("_h", "_g").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("_i", F.coalesce(F.sum("_n").over(inner), F.lit(0))).join(before, "_p")
    split = placed.select("_g", F.when(F.col("_b") + F.col("_i") < target, "validation").otherwise("train").alias("split"))
    return rows.join(split, "_g").drop("_g")


def members(df: DataFrame, group: list[str], member: str, order: str) -> DataFrame:
    """A row a group: its members in the order given, their number and the order of the first (first_seen). A group of songs or files is of a bounded size."""
    listed = df.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(member).alias("m")))).alias("_x"))
    return listed.select(*group, F.transform("_x", lambda x: x["m"]).alias("members"), F.size("_x").cast("long").alias("n_members"), F.get("_x", F.lit(0))["o"].alias("first_seen"))


def mean_of_means(df: DataFrame, batch: str, value: str) -> DataFrame:
    """One row: n_batches and the unweighted mean of batch means; an error without batches."""
    means = df.groupBy(batch).agg(F.avg(value).alias("m"))
    return means.agg(F.count("*").alias("n_batches"), F.avg("m").alias("mean_of_means")).withColumn("mean_of_means", F.when(F.col("n_batches") == 0, F.raise_error(F.lit("no batches"))).otherwise(F.col("mean_of_means")))
