"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Each 5-word shingle is hashed once. The top bits of the hash choose one of BINS bins and the least hash of a bin is its sample; an empty bin i borrows from bin h(i, 1), h(i, 2), ... until one is filled (optimal densification). Of every sample the low BITS bits are kept, one hex digit each. Two unrelated samples agree in those bits with chance 1 / 2**BITS, so likeness is (agreeing share - c) / (1 - c), c = 1 / 2**BITS, and not below 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import parts, slices, table
from tallyloom.llm.ordering import bounds, order_key, range_of
from tallyloom.llm.shingles import shingle_hashes

WIDTH, SEED, BINS, BITS = 5, 1, 512, 4
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


@cache
def _detours(block: int, bins: int) -> np.ndarray:
    """Bins that an empty bin (row) tries in turn, 32 at a time: splitmix64 of bin and attempt."""
    with np.errstate(over="ignore"):
        z = (np.arange(bins, dtype=np.uint64)[:, None] << np.uint64(32)) + np.arange(32 * block + 1, 32 * block + 33, dtype=np.uint64)[None, :]
        z = z * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) % np.uint64(bins)).astype(np.int64)


def fingerprint(text: str | None, bins: int = BINS) -> str:
    """One hex digit a bin (bins: a power of 2); texts without words have the empty fingerprint."""
    h = np.sort(shingle_hashes(text, WIDTH, SEED).astype(np.uint64))
    if not len(h):
        return ""
    at = (h >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    low, filled = np.zeros(bins, np.uint8), np.zeros(bins, bool)
    low[at[first]], filled[at[first]] = h[first] & np.uint64((1 << BITS) - 1), True
    empty, block = np.flatnonzero(~filled), 0
    while len(empty):
        tries = _detours(block % 1024, bins)[empty]
        ok = filled[tries]
        found = ok.any(axis=1)
        low[empty[found]] = low[tries[found, ok[found].argmax(axis=1)]]
        empty, block = empty[~found], block + 1
    return _DIGITS[low].tobytes().decode()


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1; two empty fingerprints are alike, an empty and another are not."""
    if not a or not b:
        return float(a == b)
    same = np.count_nonzero(np.frombuffer(a.encode(), np.uint8) == np.frombuffer(b.encode(), np.uint8)) / len(a)
    return max(0.0, (same - 1 / 2**BITS) / (1 - 1 / 2**BITS))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None
    for batch in slices(batches):
        out: list[tuple] = []
        for doc_id, text, last in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "last")), strict=True):
            print_ = fingerprint(text)
            if held is not None:
                own_id, own, own_print = held
                half = len(own) // 2
                edited = own[: len(own) - half] + text[:half]
                edited_print = fingerprint(edited)
                out.append((own_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own_print, edited_print, likeness(own_print, edited_print), likeness(own_print, print_)))
            held = None if last else (doc_id, text, print_)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)], names=names)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Each row of docs (doc_id, text; others are ignored) with its fingerprint, that of its edited text and the likeness to it and to the next document, in ascending (doc_id, text) order.

    Null texts count as empty; null doc_ids come last; equal ids are ordered by text; after the last row the first is next (a single row is its own next). Texts move once, dealt by ranges of doc_id; each range also gets the first text of the next range, so no task sees more than its range.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), order_key().alias("k"))
    cuts = bounds(rows, "k", parts(docs.sparkSession))
    firsts = [(r["part"], r["k"]) for r in rows.select("k", range_of(F.col("k"), cuts).alias("part")).groupBy("part").agg(F.min("k").alias("k")).orderBy("part").collect()]
    if not firsts:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    after = docs.sparkSession.createDataFrame([(p, k) for (p, _), (_, k) in zip(firsts, [*firsts[1:], firsts[0]])], "part int, k long")
    ends = rows.select("k", "text").join(F.broadcast(after), "k").groupBy("part").agg(F.min("text").alias("text"))  # a row a range
    dealt = rows.select("doc_id", "text", "k", F.lit(False).alias("last"), range_of(F.col("k"), cuts).cast("int").alias("part"))
    dealt = dealt.unionByName(ends.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("k"), F.lit(True).alias("last"), "part"))
    dealt = dealt.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("last", "k", "text")
    return dealt.select("doc_id", "text", "last").mapInArrow(_edited, SCHEMA)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document; see fingerprinted() for nulls, empty texts and repeated rows."""
    return fingerprinted(table(spark, sf_dir, "documents"))
