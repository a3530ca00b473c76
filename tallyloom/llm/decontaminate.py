"""Benchmark decontamination by the q-gram lemma.

Texts are normalised (lower case; runs of anything but letters and digits are one space). An item of m characters may differ from a passage by k edits, a tenth of m. Such a passage shares at least m - Q + 1 - k * Q of the item's q-grams with it, all on diagonals (place in the text - place in the item) within k of each other. Shared q-grams are counted in bands of 2 * (k + 1) diagonals that overlap by half, so some band holds them all; bands that reach the bound are verified by a banded alignment. The budget of short items is cut so that the bound is one q-gram at least; items shorter than Q are looked for as they are.

The benchmark is a stated query set. Its index is broadcast in blocks of BLOCK characters at most, one pass over the documents each, so what is broadcast never grows with the data.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import slices, stored, table

Q, BUDGET, BLOCK = 8, 0.1, 4_000_000
#: Postings that are counted at once.
MOST = 1 << 21
_BASE = 0x9E3779B97F4A7C15 | 1
_FILTER = 22
_GAPS = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    return _GAPS.sub(" ", (text or "").lower()).strip()


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(p: np.ndarray) -> np.ndarray:
    """Hash of each of the text's q-grams (Q = 8), by doubling."""
    h, base = p.astype(np.uint64) + np.uint64(1), _BASE
    for step in (1, 2, 4):
        if len(h) <= step:
            return np.empty(0, np.uint64)
        h = h[:-step] * np.uint64(base) + h[step:]
        base = base * base % (1 << 64)
    return h ^ (h >> np.uint64(29))


class Index:
    """Items with their edit budgets and bounds, and the postings of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.minimum((BUDGET * m).astype(np.int64), np.maximum(0, (m - Q) // Q))
        self.bound = m - Q + 1 - self.budget * Q
        hashes = [gram_hashes(points(t)) for t in self.texts]
        every = np.concatenate([*hashes, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([*(np.arange(len(h)) for h in hashes), np.empty(0, np.int64)]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        self.grams, self.first, self.number = np.unique(every[order], return_index=True, return_counts=True)
        self.item, self.place = item[order], place[order]
        self.short = [i for i, t in enumerate(self.texts) if len(t) < Q]
        self.seen = np.zeros(1 << _FILTER, bool)
        self.seen[(self.grams >> np.uint64(64 - _FILTER)).astype(np.int64)] = True

    def _shared(self, at: np.ndarray, i: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, place in the item, place in the text) of q-grams i of the index at places at of the text, MOST postings or one q-gram's at a time."""
        n = self.number[i]
        ends = np.cumsum(n)
        first = 0
        while first < len(i):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + MOST, "right")))
            k, own = n[first:last], i[first:last]
            post = np.repeat(self.first[own] - np.cumsum(k) + k, k) + np.arange(k.sum())
            yield self.item[post], self.place[post], np.repeat(at[first:last], k)
            first = last

    def candidates(self, p: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) of all bands that reach the item's bound."""
        h = gram_hashes(p)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - _FILTER)).astype(np.int64)])
        if not len(at):
            return []
        i = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        real = self.grams[i] == h[at]
        at, i = at[real], i[real]
        if self.number[i].sum() < self.bound.min():
            return []
        # items with too few shared q-grams in the whole text can't reach the bound in a band
        total = np.zeros(len(self.ids), np.int64)
        for item, _, _ in self._shared(at, i):
            total += np.bincount(item, minlength=len(total))
        rich = total >= self.bound
        held = [[x[rich[item]] for x in (item, place, where)] for item, place, where in self._shared(at, i) if rich[item].any()]
        if not held:
            return []
        item, place, where = (np.concatenate(x) for x in zip(*held))
        band = (where - place) // (self.budget[item] + 1)
        key = np.concatenate([item << 32 | (band + (1 << 30)), item << 32 | (band - 1 + (1 << 30))])
        full, count = np.unique(key, return_counts=True)
        full = full[count >= self.bound[full >> 32]]
        if not len(full):
            return []
        # Only different q-grams of the item count: a text may repeat one at many places of a band.
        at = np.minimum(np.searchsorted(full, key), len(full) - 1)
        kept = full[at] == key
        different = np.unique(at[kept] << 32 | np.concatenate([place, place])[kept]) >> 32
        key = full[np.bincount(different, minlength=len(full)) >= self.bound[full >> 32]]
        return [(int(k >> 32), int(k & 0xFFFFFFFF) - (1 << 30)) for k in key]


def align(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """(fewest edits between the item and a passage of the text, the passage's end), over alignments whose diagonals stay in low..high; the band's cells outside the text are out of reach."""
    width = high - low + 1
    ramp = np.arange(width)
    far = 1 << 30
    padded = np.full(len(item) + width, 0xFFFFFFFF, np.uint32)
    lo, hi = max(0, low), min(len(text), low + len(item) + width)
    if lo < hi:
        padded[lo - low : hi - low] = text[lo:hi]
    row = np.where((ramp + low >= 0) & (ramp + low <= len(text)), 0, far)
    for i, c in enumerate(item):
        step = row + (padded[i : i + width] != c)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - ramp) + ramp
        at = ramp + low + i + 1
        row = np.where((at >= 0) & (at <= len(text)), row, far)
    best = int(row.argmin())
    return int(row[best]), best + low + len(item)


def regions(text: str | None, index: Index) -> list[tuple[int, int, int, int]]:
    """(item's number, start, end, edits) of the best passage for each item within its budget; places are those of the normalised text."""
    plain = normal(text)
    p = points(plain)
    best: dict[int, tuple[int, int]] = {}
    for i, band in index.candidates(p):
        k, own = int(index.budget[i]), index.texts[i]
        if best.get(i, (1,))[0] == 0:
            continue
        if (at := plain.find(own)) >= 0:
            best[i] = (0, at + len(own))
            continue
        edits, end = align(points(own), p, band * (k + 1) - k, (band + 2) * (k + 1) + k)
        if edits <= k and (edits, end) < best.get(i, (k + 1, 0)):
            best[i] = (edits, end)
    spaced = f" {plain} "
    for i in index.short:
        if index.texts[i] and (at := spaced.find(f" {index.texts[i]} ")) >= 0:
            best[i] = (0, at + len(index.texts[i]))
    return [(i, max(0, end - len(index.texts[i])), end, edits) for i, (edits, end) in sorted(best.items())]


HITS = "doc_id long, item_id long, start long, end long, edits long, similarity double"


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items, normalised, in blocks of at most BLOCK characters (or one item); empty ones are passed over and equal ones are one, under the smallest id. Items stream to the driver."""
    block, size = [], 0
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).groupBy("text").agg(F.min("item_id").alias("item_id")).orderBy("item_id", "text")
    for r in texts.toLocalIterator():
        if plain := normal(r["text"]):
            if block and size + len(plain) > BLOCK:
                yield block
                block, size = [], 0
            block.append((r["item_id"], plain))
            size += len(plain)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits, similarity (1 - edits / item length): the best passage of each item in each document that has one within the item's edit budget.

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored. Null and empty texts hold nothing; repeated rows give repeated results; empty tables none. Documents are read where they lie; nothing is shuffled.
    """
    spark, out, left = docs.sparkSession, None, None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for block in blocks(benchmark):
        if left is not None:  # more than one block: each index goes before the next comes
            out = _given_up(*left, out)
        index = spark.sparkContext.broadcast(Index(block))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            own = index.value
            for batch in slices(batches):
                found = [(doc_id.as_py(), own.ids[i], start, end, edits, 1 - edits / len(own.texts[i])) for doc_id, text in zip(batch.column(0), batch.column(1)) for i, start, end, edits in regions(text.as_py(), own)]
                columns = list(zip(*found)) or [()] * 6
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.float64())], names=["doc_id", "item_id", "start", "end", "edits", "similarity"])

        left = rows.mapInArrow(run, HITS), index
    if left is None:
        return spark.createDataFrame([], HITS)
    return left[0] if out is None else _given_up(*left, out)


def _given_up(found: DataFrame, index, out: DataFrame | None) -> DataFrame:
    found = stored(found, "hits")
    index.unpersist()
    return found if out is None else out.unionByName(found)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, start, end, edits, similarity of the best passage of each benchmark item in each document that has one; see contaminated() for nulls, empty texts and repeated rows."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a benchmark passage, all columns as they are. Each document is judged where it lies; with more than one block of the benchmark what one block leaves is written before the next."""
    at, left = docs.columns.index("text"), None
    for block in blocks(table(spark, sf_dir, "benchmark")):
        if left is not None:
            docs = stored(docs, "clean")
            left.unpersist()
        left = index = spark.sparkContext.broadcast(Index(block))

        def keep(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield batch.filter(pa.array([not regions(t.as_py(), index.value) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
