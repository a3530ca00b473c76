"""Greedy balancing into two parts of groups of any size: blocks run side by side, and a scan joins them.

Heaviest first, each row goes to the part with the least load. Of both loads only the difference matters: a row of weight w makes it d + w where d <= 0 (the first part gets the row) and d - w elsewhere. What a block of rows makes of the difference is thus a map that shifts whole ranges of d, and maps of blocks are applied one after the other. Of each block's map only the longest ranges are kept: those that are cut off lie within the weights' decrease over the block, so the difference that comes hardly ever falls there; where it does, that block alone is folded for its outcome. Blocks then assign their parts side by side, each from the difference before it.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import shared_dir

#: Ranges kept of a block's map, and rows of a block. A block whose map doesn't say what comes out is a job by itself, one after the other: blocks grow in number with the rows, not with the cluster's shuffle partitions.
PIECES, BLOCK = 16, 250_000


def folded(weights: list[int], d: int) -> tuple[list[int], int]:
    """(part of each row, difference of loads afterwards)."""
    parts = []
    for w in weights:
        parts.append(int(d > 0))
        d += w if d <= 0 else -w
    return parts, d


def summed_up(weights: list[int], low: int, high: int, most: int = PIECES) -> list[tuple[int, int, int]]:
    """(first, last, shift) of ranges within low and high of the difference before the block, ascending: first..last become first + shift..last + shift. Of more than most the longest are kept."""
    pieces = [(low, high, 0)]
    for w in weights:
        now = []
        for a, b, s in pieces:
            if b + s <= 0:
                now.append((a, b, s + w))
            elif a + s > 0:
                now.append((a, b, s - w))
            else:
                now += [(a, -s, s + w), (1 - s, b, s - w)]
        pieces = sorted(now, key=lambda p: p[0] - p[1])[:most] if len(now) > most else now
    return sorted(pieces)


def after(pieces: list[tuple[int, int, int]], d: int) -> int | None:
    """The difference after a block by its ranges; null if they don't say."""
    i = bisect_right(pieces, d, key=lambda p: p[0]) - 1
    return d + pieces[i][2] if i >= 0 and d <= pieces[i][1] else None


def _ordered(table: pa.Table, order: str) -> pa.Table:
    return table.take(pc.sort_indices(pa.table({"w": table["_w"], "o": table[order]}), sort_keys=[("w", "descending"), ("o", "ascending")]))


def balanced(df: DataFrame, group: list[str], weight: str, order: str, unit: float = 1.0, blocks: int | None = None) -> DataFrame:
    """Adds part (0 or 1), as folds.balanced with two parts does: heaviest first, ties in the order given, the first of equal parts.

    Weights count in whole units (of 0.001, say), so sums are exact; a null weight counts as 0, a negative one is an error. Rows are carried as they are, repeated ones too; rows with a null group are a group. The rows are sorted into blocks (default: one for each BLOCK rows) and written once. What is collected are the ranges of the blocks of groups that have more than one, at most two groups' for each block.
    """
    spark, names = df.sparkSession, [f"_{c}" for c in group]
    n = blocks or max(1, -(-df.count() // BLOCK))
    w = F.round(F.coalesce(F.col(weight), F.lit(0)) / unit).cast("long")
    rows = df.drop("part").withColumn("_w", F.when(w < 0, F.raise_error(F.lit("negative weight"))).otherwise(w))
    by = [*group, F.desc("_w"), order]
    path = f"{shared_dir(spark)}/balance-{uuid.uuid4().hex}"
    rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_b", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_b", T.IntegerType())])).parquet(path)
    keys = T.StructType([T.StructField(x, rows.schema[c].dataType) for x, c in zip(names, group, strict=True)])
    several = rows.groupBy(*group).agg(F.array_sort(F.collect_set("_b")).alias("b")).where(F.size("b") > 1).collect()
    start = _starts(rows, group, names, keys, order, [(tuple(r[c] for c in group), r["b"]) for r in several]) if several else []
    known = spark.createDataFrame(start, T.StructType([*keys.fields, *T.StructType.fromDDL("_block int, _d long").fields]))
    on = [F.col(c).eqNullSafe(F.col(x)) for c, x in zip(group, names, strict=True)] + [F.col("_b") == F.col("_block")]
    rows = rows.join(F.broadcast(known), on, "left").drop(*names, "_block").withColumn("_d", F.coalesce("_d", F.lit(0)))

    def assign(table: pa.Table) -> pa.Table:
        table = _ordered(table, order)
        parts, _ = folded(table["_w"].to_pylist(), table["_d"][0].as_py())
        return table.drop_columns(["_w", "_b", "_d"]).append_column("part", pa.array(parts, pa.int32()))

    out = T.StructType([*df.drop("part").schema.fields, T.StructField("part", T.IntegerType())])
    return rows.groupBy(*group, "_b").applyInArrow(assign, out)


def _starts(rows: DataFrame, group: list[str], names: list[str], keys: T.StructType, order: str, several: list[tuple[tuple, list[int]]]) -> list[tuple]:
    """(group, block, difference before it) of all blocks of the groups given."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(*g, b) for g, bs in several for b in bs], T.StructType([*keys.fields, T.StructField("_block", T.IntegerType())]))
    on = [F.col(c).eqNullSafe(F.col(x)) for c, x in zip(group, names, strict=True)] + [F.col("_b") == F.col("_block")]
    narrow = rows.select(*dict.fromkeys([*group, order]), "_w", "_b").join(F.broadcast(wanted), on, "left_semi")

    def summary(table: pa.Table) -> pa.Table:
        weights = _ordered(table, order)["_w"].to_pylist()
        pieces = summed_up(weights, -2 * weights[0], 2 * weights[0])
        own = {c: pa.array([table[c][0].as_py()], table[c].type) for c in group}
        return pa.table(own | {"_b": pa.array([table["_b"][0].as_py()], pa.int32()), "zero": pa.array([folded(weights, 0)[1]], pa.int64()), "pieces": pa.array([[x for p in pieces for x in p]], pa.list_(pa.int64()))})

    kinds = T.StructType([*(rows.schema[c] for c in group), *T.StructType.fromDDL("_b int, zero long, pieces array<long>").fields])
    maps = {(tuple(r[c] for c in group), r["_b"]): r for r in narrow.groupBy(*group, "_b").applyInArrow(summary, kinds).collect()}

    def outcome(g: tuple, b: int, d: int) -> int:
        def fold(table: pa.Table) -> pa.Table:
            return pa.table({"d": pa.array([folded(_ordered(table, order)["_w"].to_pylist(), d)[1]], pa.int64())})

        own = narrow.where(F.col("_b") == b)
        for c, v in zip(group, g, strict=True):
            own = own.where(F.col(c).eqNullSafe(F.lit(v)))
        return own.groupBy("_b").applyInArrow(fold, "d long").first()["d"]

    out = []
    for g, bs in several:
        d = 0
        for b in bs:
            out.append((*g, b, d))
            r = maps[g, b]
            flat = r["pieces"]
            known = r["zero"] if d == 0 else after([tuple(flat[i : i + 3]) for i in range(0, len(flat), 3)], d)
            d = outcome(g, b, d) if known is None else known
    return out
