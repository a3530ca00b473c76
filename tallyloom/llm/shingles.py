"""Hashes of word shingles of whole texts."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, width: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle of width words, repeats included, as big-endian uint64; fewer words make one shingle of all, no words none. A-Z are lower-cased; words are split at 0x20 and 0x09 to 0x0D; words of a shingle are joined by one space."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return np.empty(0, ">u8")
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= width:
        return np.frombuffer(digest(joined, seed), ">u8")
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-width]]
    return np.frombuffer(b"".join([digest(joined[s : e - 1], seed) for s, e in zip(starts, ends[width - 1 :])]), ">u8")
