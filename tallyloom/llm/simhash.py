"""SimHash near-duplicates: a forest of vantage-point trees over fingerprints.

Two fingerprints link at `radius` (4) or fewer differing bits. Of `TREES` (3) disjoint blocks of bits, one at least then differs in no more than radius // 3 = 1 bit, and Hamming distance on a block is a (pseudo)metric. So each block gets a vantage-point tree whose query radius is 1 instead of 4: a node holds a vantage point and a cut, near fingerprints go left and the others right; a fingerprint within the radius of the cut is also sent over to the right side as a guest. A pair that a node parts is thus met by its left member as a guest in the right member's leaf; every other branch is pruned by the triangle inequality. Leaves are the shards; full 64-bit distances decide there, so links are exact.

Trees are fitted on a bounded sample of distinct fingerprints, POINTS for each leaf that is aimed at and SAMPLE at most; they decide only where the work goes, so a forest has up to SAMPLE / POINTS leaves a tree. Leaves that are still large are split again where they are, by a tree of their own. In a leaf, links are reduced to a spanning forest before they leave it, so a dense group costs rows in proportion to its members and not to their pairs. Exact copies are one fingerprint throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import alike
from tallyloom.llm.common import among, scratch, sized, slices, stored, table
from tallyloom.llm.components import connected_components
from tallyloom.llm.shingles import shingle_hashes

WIDTH, SEED, RADIUS = 4, 42, 4
TREES = 3
#: Fingerprints the shard trees are fitted on, at most, and for each leaf; fingerprints a shard aims at; fingerprints that a leaf compares directly.
SAMPLE, POINTS, SHARD, LEAF = 1 << 20, 16, 8_192, 768
#: Words of a shingle in the pipeline's stage, and documents that tell it how rare shingles are (about); no link depends on the latter.
WORDS, RARITY = 5, 20_000
#: Bits within which fingerprints are candidates in the pipeline's stage.
REACH = 8


def simhash(text: str | None) -> int:
    """64 bits; bit i is set if it is set in over half of the hashes of the word shingles. No words: 0."""
    return majority(shingle_hashes(text, WIDTH, SEED))


def majority(h: np.ndarray) -> int:
    if not len(h):
        return 0
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        prints = np.fromiter((simhash(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) of every document; null texts count as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long")


def masks(trees: int = TREES) -> np.ndarray:
    cuts = [64 * i // trees for i in range(trees + 1)]
    return np.array([((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])], np.uint64)


def fit_tree(x: np.ndarray, leaf: int, rng: np.random.Generator) -> tuple | None:
    """Nested (vantage point, cut, left, right); None is a leaf. Points no farther than the cut go left. x: a block's bits of each fingerprint."""
    if len(x) <= leaf:
        return None
    best = None
    for v in rng.choice(x, 5):
        d = np.bitwise_count(x ^ v)
        for cut in {max(0, int(np.median(d)) - 1), int(np.median(d))}:
            left = np.count_nonzero(d <= cut)
            cost = max(left, len(x) - left) + np.count_nonzero((d <= cut) & (d + 1 > cut))
            if 0 < left < len(x) and (best is None or cost < best[0]):
                best = cost, v, cut, d
    if best is None or best[0] >= len(x):
        return None
    _, v, cut, d = best
    return np.uint64(v), cut, fit_tree(x[d <= cut], leaf, rng), fit_tree(x[d > cut], leaf, rng)


def route(tree: tuple | None, x: np.ndarray, radius: int, guest: np.ndarray, rows: np.ndarray, at: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, rows, whether each is a guest) of all leaves that rows of x come to."""
    if not len(rows):
        return
    if tree is None:
        yield at, rows, guest
        return
    v, cut, left, right = tree
    d = np.bitwise_count(x[rows] ^ v).astype(np.int16)
    near = d <= cut
    go = near | (guest & (d <= cut + radius))
    yield from route(left, x, radius, guest[go], rows[go], 2 * at)
    go = ~near | (d + radius > cut)
    yield from route(right, x, radius, (guest | near)[go], rows[go], 2 * at + 1)


def _forest(fp: np.ndarray, member: np.ndarray, mask: np.uint64, radius: int, leaf: int, limit: int) -> list[np.ndarray]:
    """Edges (rows of fp, 2 x n) that span what links reach among members and from members to guests."""
    x, edges = fp & mask, []
    tree = fit_tree(x[member], leaf, np.random.default_rng(7)) if np.count_nonzero(member) > leaf else None
    for _, rows, guest in route(tree, x, radius, ~member, np.arange(len(fp))):
        inner = np.flatnonzero(~guest)
        rows = np.concatenate([rows[inner], np.delete(rows, inner)])
        left, n_in = np.arange(len(rows)), len(inner)
        values = fp[rows]
        while len(left) and left[0] < n_in:  # breadth first over what no walk has reached
            queue = [left[0]]
            left = left[1:]
            while queue and len(left):
                i = queue.pop()
                over = left if i < n_in else left[: np.searchsorted(left, n_in)]
                near = np.bitwise_count(values[over] ^ values[i]) <= limit
                if near.any():
                    hit = over[near]
                    edges.append(np.stack([np.full(len(hit), rows[i]), rows[hit]]))
                    left = np.concatenate([over[~near], left[len(over) :]])
                    queue.extend(hit.tolist())
    return edges


def _linker(radius: int, limit: int, leaf: int, own: np.ndarray):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        fp, member = group["fp"].to_numpy().view(np.uint64), ~group["guest"].to_numpy(bool)
        edges = _forest(fp, member, own[int(group["tree"].iloc[0])], radius, leaf, limit) if member.any() else []
        a, b = np.concatenate(edges, axis=1) if edges else np.empty((2, 0), np.int64)
        return pd.DataFrame({"a": fp[a].view(np.int64), "b": fp[b].view(np.int64)})

    return link


def links(prints: DataFrame, limit: int = RADIUS, trees: int = TREES, shard: int = SHARD, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """a, b: edges between distinct fingerprints (column fp) whose components are those of all pairs within limit bits."""
    spark, radius, own = prints.sparkSession, limit // trees, masks(trees)
    n = prints.count()
    wanted = min(sample, max(65_536, POINTS * n // shard))
    # fingerprints are distinct, so a threshold on their hash picks about as many as are wanted, without a sort
    some = prints.select("fp").where(F.col("fp").isNotNull() & (F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) <= (wanted << 20) // max(n, wanted)))
    picked = np.sort(some.toArrow()["fp"].to_numpy() if n > shard else np.empty(0, np.int64)).view(np.uint64)
    rng = np.random.default_rng(1)
    forest = [fit_tree(picked & m, max(POINTS, shard * len(picked) // max(n, 1)), rng) for m in own]
    shared = spark.sparkContext.broadcast(forest)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).to_numpy()
            fp = raw.view(np.uint64)
            for t, tree in enumerate(shared.value):
                for at, rows, guest in route(tree, fp & own[t], radius, np.zeros(len(fp), bool), np.arange(len(fp))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), t, np.int32)), pa.array(np.full(len(rows), at, np.int64)), pa.array(raw[rows]), pa.array(guest)], names=["tree", "leaf", "fp", "guest"])

    dealt = prints.select("fp").mapInArrow(deal, "tree int, leaf long, fp long, guest boolean")
    return dealt.groupBy("tree", "leaf").applyInPandas(_linker(radius, limit, leaf, own), "a long, b long")


def classes(docs: DataFrame, limit: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id of every row of docs (columns doc_id, text; others are ignored).

    component_id is the smallest doc_id reachable over links, itself included. Null and empty texts have fingerprint 0 and link like any other; repeated rows stay; a null doc_id is never the smallest while another is there; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs), "prints")
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    distinct = stored(reps, "reps")
    roots = connected_components(links(distinct, limit))
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("rep").alias("component_id"))
    return prints.join(of.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    return classes(table(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _set(hashes: np.ndarray) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    return np.unique(hashes.astype(np.uint64))


def parity(own: np.ndarray) -> np.ndarray:
    """The parity sketch (alike.py) of distinct hashes, 4 signed longs."""
    odd = np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    # the low two of the top eight bits choose the column, the high six the bit
    return (odd.reshape(64, 4).T.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [_set(shingle_hashes(t.as_py(), WORDS, SEED)) for t in batch.column(0)]
        keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["key", "shingles"])


#: Bits of the parity that says which pairs' whole sets are worth moving; 256 (alike.py) part no sets of a thousand elements.
WIDE = 4096


def wide_parity(own: np.ndarray) -> np.ndarray:
    """For each of WIDE hash values, whether an odd number of the distinct hashes has it: WIDE / 64 signed longs."""
    odd = np.bincount((own >> np.uint64(64 - WIDE.bit_length() + 1)).astype(np.int64), minlength=WIDE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _wide_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sets(batches):
        wide = [wide_parity(s.values.to_numpy().view(np.uint64)) for s in batch.column(1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(wide, pa.list_(pa.int64()))], names=["key", "shingles", "wide"])


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose wide parities (sets: key, shingles, wide; repeats agree) allow 0.8."""
    return alike.within(pairs, sets.select("key", F.size("shingles").alias("n"), "wide").groupBy("key").agg(F.first("n").alias("n"), F.first("wide").alias("wide")))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, t1, t2 (hashes of the text), root (the class), component_id of every row of docs, by the exact Jaccard similarity of the sets of 5-word shingles (0.8 or more).

    Candidates come from the forest of vantage-point trees over fingerprints of 5-word shingles (links()), then from rare shingles that documents share; each is verified on whole sets. 64 bits can't tell a similarity of 0.8 for all pairs, so a prefix filter (alike.py) completes them: no pair is lost. Texts with one set of shingles are one class throughout; those without words are one. Only the prefixes of all texts are moved, a wide parity of each candidate, and whole sets of the candidates that these don't part. component_id is the smallest doc_id of the class (null if it has none).
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))
    every = max(1, rows.count() // RARITY)
    some = rows.where(F.pmod(F.xxhash64("doc_id", "t1"), F.lit(every)) == 0).select("text")
    shared = docs.sparkSession.sparkContext.broadcast(np.array(alike.levels(some.mapInArrow(_sets, "key binary, shingles array<long>").select(F.explode("shingles"))), np.int64))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, prints, sizes, sketches, parts = [], [], [], [], []
            for t in batch.column(3):
                hashes = shingle_hashes(t.as_py(), WORDS, SEED)
                own = _set(hashes)
                signed = own.view(np.int64)
                order = np.lexsort((signed, shared.value[signed % alike.BUCKETS]))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                prints.append(majority(hashes))
                sizes.append(len(own))
                sketches.append(parity(own))
                parts.append(signed[order[: alike.prefix_size(len(own)) if len(own) else 0]])
            fp, sketch = np.array(prints, np.uint64).view(np.int64), np.array(sketches, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keys, pa.binary()), pa.array(fp), pa.array(sizes, pa.int32()), *(pa.array(sketch[:, k].copy()) for k in range(4)), pa.array(parts, pa.list_(pa.int64()))], names=["doc_id", "t1", "t2", "key", "fp", "n", *alike.PARITY, "prefix"])

    prints = stored(rows.mapInArrow(prefixes, "doc_id long, t1 long, t2 long, key binary, fp long, n int, p0 long, p1 long, p2 long, p3 long, prefix array<long>"), "prefixes")
    distinct = stored(prints.groupBy("key").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))["doc_id"].alias("least"), F.min("fp").alias("fp"), *(F.first(c).alias(c) for c in ("n", *alike.PARITY, "prefix"))), "distinct")
    places = alike.shared(distinct)

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stored(alike.able(pairs, distinct), "pairs")
        keys = pairs.select(F.col("a").alias("key")).distinct().unionByName(pairs.select(F.col("b").alias("key")).distinct()).distinct()
        ids = stored(distinct.join(keys, "key", "left_semi").select("rep.*").distinct(), "wanted")
        texts = among(rows, ids, ["doc_id", "t1", "t2"]).select("text")
        # whole sets stay where they were made; those of possible pairs alone are dealt out
        every = stored(texts.mapInArrow(_wide_sets, "key binary, shingles array<long>, wide array<long>"), "sets")
        pairs = stored(possible(pairs, every), "possible")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        sets = among(every.select("key", "shingles"), ends, ["key"]).dropDuplicates(["key"])
        sides = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
        n = F.size("x") + F.size("y")
        return stored(sides.where((5 * F.least(F.size("x"), F.size("y")) >= 4 * F.greatest(F.size("x"), F.size("y"))) & (9 * F.size(F.array_intersect("x", "y")) >= 4 * n)).select("a", "b"), "links")

    heads = stored(distinct.where("n > 0").groupBy("fp").agg(F.min("key").alias("head")), "heads")
    near = links(heads.select("fp"), REACH)
    near = stored(near, "near").join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b").select("x", "y")
    same = distinct.select("key", "fp", "n").where("n > 0").join(heads, "fp").where("key <> head").select(F.col("key").alias("x"), F.col("head").alias("y"))
    first = near.unionByName(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    first = verified(first.unionByName(alike.neighbours(places)).distinct())
    edges = alike.completed(places, first, verified)
    of = distinct.select("key", "least").join(sized(connected_components(edges).withColumnRenamed("node", "key")), "key", "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.select("doc_id", "t1", "t2", "key").join(of.join(least, "root").select("key", "root", "component_id"), "key").select("doc_id", "t1", "t2", "root", "component_id")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every class of near copies (near_classes) one row stays, with all its columns: the one with the smallest doc_id (null last), then the smallest hashes of its text. Of rows with equal doc_id and text one stays. What goes is decided on narrow rows; texts are moved only where more go than can be broadcast."""
    with scratch(spark):
        of = stored(near_classes(docs), "classes", keep=True)
    rows = of.groupBy("doc_id", "t1", "t2").agg(F.first("root").alias("root"), F.count("*").alias("n")).withColumn("at", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2"))
    first = rows.groupBy("root").agg(F.min("at").alias("first"))
    judged = stored(rows.join(first, "root").select("doc_id", "t1", "t2", "n", F.col("at").eqNullSafe(F.col("first")).alias("stays")), "judged")
    text, on = F.col("row.text").cast("string"), ["id", "t1", "t2"]
    own = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")).withColumns({"id": F.col("row.doc_id").cast("long"), "t1": F.xxhash64(text), "t2": F.xxhash64(F.lit(1), text)})
    keys = judged.withColumnRenamed("doc_id", "id")
    single = among(own, keys.where("NOT stays OR n > 1"), on, "left_anti")
    repeated = among(own, keys.where("stays AND n > 1"), on).dropDuplicates(on)
    return single.unionByName(repeated).select("row.*")
