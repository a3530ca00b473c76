"""Fingerprints and both likeness columns against a plain loop over bins."""

import duckdb
import pytest
import xxhash

from tallyloom.llm import fingerprints

SF = "/root/testdata/sf0.001"
MASK = 2**64 - 1


def detour(i, attempt):
    """The bin that empty bin i tries at an attempt: splitmix64 of both."""
    z = ((i << 32) + attempt) * 0x9E3779B97F4A7C15 & MASK
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & MASK
    z = (z ^ z >> 27) * 0x94D049BB133111EB & MASK
    return (z ^ z >> 31) % 512


def plain(text):
    """One-permutation MinHash: the least hash of each of 512 bins, empty bins filled from the first filled bin of their detours, 4 low bits each."""
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return ""
    shingles = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
    least = {}
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 1)
        least[h >> 55] = min(least.get(h >> 55, MASK), h)
    out = []
    for i in range(512):
        attempt, at = 0, i
        while at not in least:
            attempt += 1
            at = detour(i, attempt)
        out.append("0123456789abcdef"[least[at] & 15])
    return "".join(out)


def alike(a, b):
    if not a or not b:
        return float(a == b)
    same = sum(x == y for x, y in zip(a, b, strict=True)) / 512
    return max(0.0, (same - 1 / 16) / (15 / 16))


def test_columns_by_loop(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())
    ids = sorted(texts)
    prints = {d: plain(texts[d]) for d in ids}
    for r in fingerprints.op1_fingerprints(spark, SF).collect():
        own, after = texts[r["doc_id"]], ids[(ids.index(r["doc_id"]) + 1) % len(ids)]
        half = len(own) // 2
        edited = plain(own[: len(own) - half] + texts[after][:half])
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(own), prints[r["doc_id"]], edited)
        assert r["near_edited"] == pytest.approx(alike(r["fingerprint"], edited)) and r["near_next"] == pytest.approx(alike(r["fingerprint"], prints[after]))
