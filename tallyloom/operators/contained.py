"""Which texts hold which items, as an equi-join."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of items that are broadcast at once, and of anchors that are written into the plan.
BLOCK, ANCHORS = 8 << 20, 1 << 20
_GAP = r"[^\p{L}\p{N}]+"


def contained(docs: DataFrame, items: DataFrame, doc: str, item: str) -> DataFrame:
    """doc, item of each pair where the item's text stands in the document's, whatever the case. docs: doc, text; items: item, text (a stated query set).

    An item of three words or more is met by its anchor, of its inner words the one that the fewest items have (of equals the longest): a document that holds the item holds that word between gaps. Only pairs that share an anchor are compared. While the anchors are few, a text is cut into words where it lies and goes on with those of them that are anchors; else (document, word) pairs meet the anchors without texts, and the texts of candidates are fetched by a second reading. Items without an anchor are compared with all texts where these lie, in blocks of a checked size.
    """
    texts = docs.select(doc, F.lower("text").alias("_low"))
    low = items.select(item, F.lower("text").alias("_item")).where("_item IS NOT NULL")
    words = F.split("_item", _GAP)
    inner = F.filter(F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0))), lambda w: w != "")
    low = low.withColumn("_inner", F.array_distinct(inner))
    counts = low.select(F.explode("_inner").alias("_word")).groupBy("_word").agg(F.count("*").alias("_n"))
    ranked = low.where(F.size("_inner") > 0).select(item, "_item", F.explode("_inner").alias("_word")).join(counts, "_word")
    anchored = ranked.groupBy(item, "_item").agg(F.min_by("_word", F.struct("_n", -F.length("_word"), "_word")).alias("_anchor"))
    anchors = anchored.select("_anchor").distinct()
    size, held = anchored.agg(F.coalesce(F.sum(F.octet_length("_item")), F.lit(0))).first()[0], anchors.agg(F.coalesce(F.sum(F.octet_length("_anchor") + 4), F.lit(0))).first()[0]
    split = F.split("_low", _GAP)
    if size <= BLOCK and held <= ANCHORS:
        known = F.from_json(F.lit(json.dumps(sorted(r[0] for r in anchors.collect()))), "array<string>")
        met = texts.select(doc, "_low", F.explode(F.array_intersect(split, known)).alias("_anchor"))
        found = met.join(F.broadcast(anchored), "_anchor").where(F.contains("_low", F.col("_item"))).select(doc, item)
    else:
        keyed = texts.withColumn("_key", F.md5("_low"))
        pairs = keyed.select("_key", F.explode(F.array_distinct(split)).alias("_anchor")).join(anchored.drop("_item"), "_anchor").select("_key", item).distinct()
        there = pairs.join(keyed.select("_key", "_low").join(pairs.select("_key").distinct(), "_key", "left_semi").groupBy("_key").agg(F.first("_low").alias("_low")), "_key").join(anchored.drop("_anchor"), item).where(F.contains("_low", F.col("_item")))
        found = keyed.select(doc, "_key").join(there.select("_key", item), "_key").select(doc, item)
    short = low.where(F.size("_inner") == 0).drop("_inner")
    size = short.agg(F.sum(F.octet_length("_item") + 1)).first()[0] or 0
    blocks = [short.where(F.pmod(F.xxhash64(item), F.lit(n)) == i) for n in [size // BLOCK + 1] for i in range(n)] if size else []
    return reduce(DataFrame.unionByName, [texts.join(F.broadcast(b), F.contains("_low", F.col("_item"))).select(doc, item) for b in blocks], found)
