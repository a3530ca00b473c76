"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only.

Every source's documents are shuffled by a hash. A document's virtual finish time is the source's tokens up to and with it, divided by the source's target; a source that repeats goes on counting through its passes. A copy that is in service at virtual time 1 is two pieces, the words up to then and the rest, so that no source is held up by a long document. The pieces of all sources are put into ranges of finish time and sorted there, their running sum is taken over the ranges in order, and the mix ends where it reaches the total budget, the sum of the targets in whole words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import parts, stored, table
from tallyloom.llm.ordering import range_of

WEIGHTS, MOST_PASSES, SEED = (5, 2, 1), 3, "mix"
#: White space as the contract has it.
SPACES = " \t\n\x0b\x0c\r"
#: Rows of one source that a bucket of the shuffled order aims at.
BUCKET = 4096


def word_count(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+; null: 0."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(bare, F.lit("")) == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST_PASSES) -> DataFrame:
    """source, source_size, target (sizes: a row a source: source, source_size).

    Sources by code point, null last, weigh as in weights, repeating. share of all sizes is dealt out by weight; a target stops at most times its source's size and the excess is dealt out anew by weight until none is above. That level is found in closed form: sources fill up in the order of size / weight, so running sums in that order say at which source the level stops. The windows hold one row a source.
    """
    named = sizes.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.coalesce("source", F.lit("")))) - 1)
    named = named.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")).cast("double")).withColumn("cap", (most * F.col("source_size")).cast("double"))
    before = Window.orderBy(F.col("cap") / F.col("w"), "at").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    run = named.withColumn("filled", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("others", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    run = run.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(whole) - F.col("filled")) / F.col("others"))
    # The level is that of the first source in this order that it does not fill; if there is none, each target is its cap.
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "at", "level"))).over(whole)["level"]
    return run.select("source", "source_size", F.coalesce(F.least(F.col("cap"), level * F.col("w")), F.col("cap")).alias("target"))


def served(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST_PASSES) -> tuple[DataFrame, int]:
    """(docs with source_size, target, queue, begin and pieces; the total budget). docs: doc_id, source, size, and whatever else it carries.

    queue is the source as a key and begin the words of its queue before the document, so (queue, begin) names a document that has words. pieces: number of the pass, finish (virtual time) and words of each piece, up to two a pass; none without words. Null sources are one source of their own; null sizes count as 0; equal ids are ordered by size. The running sum of a source is taken in buckets of its hash order, whose starts come from the sums of buckets, so no task holds a hot source. The input is read three times and shuffled once. Columns named like those added are replaced.
    """
    bits = max(0, (docs.count() // BUCKET).bit_length())
    h = F.md5(F.concat(F.lit(SEED + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.withColumns({"size": F.coalesce("size", F.lit(0)).cast("long"), "_h": h, "queue": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))})
    rows = rows.withColumn("_b", F.shiftright(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), 32 - bits).cast("int"))
    own = stored(rows.groupBy("queue", "_b").agg(F.first("source").alias("source"), F.sum("size").alias("own")), "buckets")
    goal = targets(own.groupBy("queue").agg(F.first("source").alias("source"), F.sum("own").alias("source_size")).select("source", "source_size"), weights, share, most)
    goal = stored(goal.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("queue"), "source_size", "target"), "targets")
    starts = own.select("queue", "_b", F.coalesce(F.sum("own").over(Window.partitionBy("queue").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")).join(goal, "queue")
    inner = Window.partitionBy("queue", "_b").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.drop("source_size", "target", "begin", "pieces", "_upto", "_before").withColumn("_upto", F.sum("size").over(inner)).join(starts, ["queue", "_b"])
    rows = rows.withColumn("begin", F.col("_before") + F.col("_upto") - F.col("size"))
    cut = F.floor("target").cast("long")

    def two(i: int) -> list[Column]:
        begin = F.col("begin") + i * F.col("source_size")
        end, words = begin + F.col("size"), F.greatest(F.lit(0), F.least(F.col("size"), cut - begin))
        return [F.struct(F.lit(i).alias("pass"), F.try_divide(stop, F.col("target")).alias("finish"), n.cast("long").alias("words")) for stop, n in ((F.least(end, cut), words), (end, F.col("size") - words))]

    pieces = F.filter(F.array(*(p for i in range(most) for p in two(i))), lambda p: p["words"] > 0)
    budget = goal.agg(F.sum(F.floor("target"))).first()[0]
    return rows.withColumn("pieces", pieces).drop("_b", "_h", "_upto", "_before"), int(budget or 0)


ORDER = ["finish", "queue", "begin"]


def truncated(rows: DataFrame, budget: int) -> DataFrame:
    """The pieces of served() rows (their other columns with them) in the global order of finish, queue and begin, with taken: the words of each that the budget still pays for. Ranges of finish time are quantiles, written into the plan; only a sum a range is summed up in one task."""
    every = stored(rows.select(*(c for c in rows.columns if c != "pieces"), F.explode("pieces").alias("_p")).select("*", "_p.pass", "_p.finish", "_p.words").drop("_p"), "pieces")
    n = parts(rows.sparkSession)
    cuts = every.agg(F.percentile_approx("finish", [i / n for i in range(1, n)], max(10_000, 50 * n)).alias("cuts")).first()["cuts"] if n > 1 else []
    every = every.withColumn("_range", range_of(F.col("finish"), sorted(set(cuts or []))).cast("int"))
    sums = every.groupBy("_range").agg(F.sum("words").alias("_sum"))
    before = sums.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    upto = F.sum("words").over(Window.partitionBy("_range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0))
    run = every.withColumn("_upto", upto).join(before, "_range")
    left = F.lit(budget) - F.col("_start") - F.col("_upto") + F.col("words")
    return run.withColumn("taken", F.greatest(F.lit(0), F.least(F.col("words"), left)).cast("long")).drop("_range", "_start", "_upto")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    sized = stored(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    rows, budget = served(sized)
    rows = stored(rows, "served")
    taken = truncated(rows.select("doc_id", "size", "source_size", "target", "queue", "begin", "pieces"), budget)
    own = taken.groupBy("queue", "begin").agg(*(F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")), F.sum("taken").alias("taken"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return own.select(columns).unionByName(rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(columns))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS pos FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE pos % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w, CAST(3 * source_size AS DOUBLE) AS cap FROM s),
r AS (SELECT *, coalesce(sum(cap) OVER o, 0) AS filled, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS others, CAST(sum(source_size) OVER () AS DOUBLE) AS whole FROM w WINDOW o AS (ORDER BY cap / w, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((whole - filled) / others, row(cap / w, pos)) AS level FROM r WHERE (whole - filled) / others * w <= cap),
t AS (SELECT source, source_size, coalesce(least(cap, level * w), cap) AS target FROM r LEFT JOIN l ON true),
e AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, CAST(floor(target) AS BIGINT) - (upto - size)))
     + greatest(0, least(size, CAST(floor(target) AS BIGINT) - (upto - size + source_size)))
     + greatest(0, least(size, CAST(floor(target) AS BIGINT) - (upto - size + 2 * source_size))) AS BIGINT) AS taken
FROM e
"""


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mix of docs in the order of finish times, with the columns of docs; a document taken in several passes is there as often, and one that the end of the budget cuts keeps its first words (n_chars follows). Documents that the mix has no room for go, and so do those without words.

    The end of the mix is found on narrow rows; texts move to their queue's buckets and then into the order.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    narrow, budget = served(stored(sized, "sizes"))
    last = truncated(narrow.select("queue", "begin", "pieces"), budget).where("taken > 0").agg(F.max(F.struct(*ORDER, "taken")).alias("last")).first()["last"]
    rows, _ = served(sized.select("doc_id", "source", "size").limit(0) if last is None else docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.struct(*(docs[c] for c in docs.columns)).alias("row")))
    if last is None:
        return docs.limit(0)
    pieces = rows.select("size", "row", "queue", "begin", F.explode("pieces").alias("_p")).select("*", "_p.*")
    here, end = F.struct(*ORDER), F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["queue"]).alias("queue"), F.lit(last["begin"]).alias("begin"))
    pieces = pieces.where(here <= end).withColumn("words", F.when(here == end, F.lit(last["taken"])).otherwise(F.col("words")))
    cut, text = F.col("words") < F.col("size"), F.col("row.text")
    split = F.split(F.ltrim(text, F.lit(SPACES)), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    copies = pieces.withColumn("head", F.when(cut, F.rtrim(F.array_join(F.slice(split, 1, F.col("words").cast("int")), ""), F.lit(SPACES))))
    in_order = copies.repartitionByRange(parts(spark), *ORDER).sortWithinPartitions(*ORDER)
    changed = {"text": F.coalesce("head", text), "n_chars": F.coalesce(F.length("head").cast("long"), F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return in_order.select(*(changed.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))
