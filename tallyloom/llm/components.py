"""Connected components of an undirected graph by alternating large-star and small-star steps, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import scratch, stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Every node that has an edge to another node: node, root (the smallest node of its component, itself included).

    Nodes are of any type with an order. Edges with a null end, loops and repeats are ignored; no edges give an empty result. Each round is a few aggregations by key (minimum only, so a hub is summed before the shuffle) and two equi-joins, which skewed hubs can split; the edges of each round are written to the shared folder. Nothing but a count and a checksum reaches the driver.
    """
    x, y = F.col(a), F.col(b)
    links = edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    with scratch(edges.sparkSession):
        links = _settled(stored(links, "links"), most_rounds)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _settled(links: DataFrame, most_rounds: int) -> DataFrame:
    """u, v: every node but the roots, and its root."""
    seen = None
    for _ in range(most_rounds):
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return stored(links, "roots", keep=True)
        seen = now
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
