"""Global order without a global sort in one task.

Bounds are quantiles of the key, one per partition, taken once and then written into the plan as literals, so a recomputed task sees the same ranges. What crosses to the driver is a row per partition.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST = 2**63 - 1


def order_key(doc_id: str = "doc_id") -> Column:
    """doc_id as a sort key; null comes last."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """At most n - 1 ascending inner bounds of n ranges with about as many rows each."""
    if n < 2:
        return []
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], max(10_000, 50 * n)).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def range_of(key: Column, cuts: list) -> Column:
    """Number of cuts not above the key: the key's range, found in two levels of about the square root of their number."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts) - 1) + 1
    kind = "double" if isinstance(cuts[0], float) else "bigint"
    chunks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.from_json(F.lit(json.dumps([c[0] for c in chunks])), f"array<{kind}>")
    fine = F.from_json(F.lit(json.dumps(chunks)), f"array<array<{kind}>>")
    at = F.size(F.filter(heads, lambda b: b <= key))
    return F.when(at == 0, 0).otherwise((at - 1) * step + F.size(F.filter(F.element_at(fine, F.greatest(at, F.lit(1))), lambda b: b <= key)))


def in_ranges(df: DataFrame, key: str, cuts: list, *then: str) -> DataFrame:
    """df with its range as column part; partition i holds range i, sorted by key and then by the columns named."""
    out = df.withColumn("part", range_of(F.col(key), cuts).cast("int"))
    return out.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(key, *then)
