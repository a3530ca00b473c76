"""Canonical length-limited Huffman codes: lengths, codes, vectorised encoding and table-driven decoding from bit-offset checkpoints."""

from __future__ import annotations

import numpy as np

MOST_BITS = 18
#: Symbols between two checkpoints inside a document.
STRIDE = 256


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most `most` bits by package-merge; symbols with count 0 have length 0; a single symbol has length 1."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols do not fit into codes of {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64) if counts.sum() < 2**53 else counts[order].astype(np.longdouble)
    # levels[d] says, for each item of the d-th merged list, whether it is a leaf
    merged, levels = weight, []
    is_leaf = np.ones(len(weight), bool)
    for _ in range(most - 1):
        levels.append(is_leaf)
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        at = np.argsort(both, kind="stable")
        merged, is_leaf = both[at], at < len(weight)
    levels.append(is_leaf)
    take, out = 2 * len(weight) - 2, np.zeros(len(weight), np.int64)
    for is_leaf in reversed(levels):
        leaves = np.count_nonzero(is_leaf[:take])
        out[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = out
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each symbol, symbols in code order)."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    codes, code, before = np.zeros(len(lengths), np.uint32), 0, 0
    own = lengths[order].astype(np.int64)
    top = int(own.max()) if len(own) else 0
    steps = np.left_shift(1, top - own)  # each code's share of the code space, in units of the longest code
    starts = np.concatenate([[0], np.cumsum(steps)[:-1]]) if len(own) else np.empty(0, np.int64)
    codes[order] = starts >> (top - own)
    return codes, order


def decode_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits to peek at, symbol for each peeked value, its length)."""
    _, order = canonical(lengths)
    own = lengths[order].astype(np.int64)
    top = int(own.max()) if len(own) else 1
    share = np.left_shift(1, top - own)
    symbols, sizes = np.zeros(1 << top, np.uint32), np.ones(1 << top, np.uint8)
    full = np.repeat(order, share)
    symbols[: len(full)], sizes[: len(full)] = full, np.repeat(own, share)
    return top, symbols, sizes


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bit stream, padded to whole bytes; bit offset of each symbol)."""
    stream, _, starts = encode_each(ids, np.array([len(ids)]), codes, lengths)
    return stream, starts


def encode_each(ids: np.ndarray, n: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(bit streams of documents one after the other, each padded to whole bytes; the byte at which each ends; bit offset of each symbol in all). n: symbols of each document, whose ids lie one after the other."""
    if not len(ids):
        return b"", np.zeros(len(n), np.int64), np.empty(0, np.int64)
    size = lengths[ids].astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(size)])
    last = np.cumsum(n)
    own = (upto[last] - upto[last - n] + 7) // 8  # bytes of each document
    ends = np.cumsum(own)
    starts = upto[:-1] + np.repeat(8 * (ends - own) - upto[last - n], n)
    # Each code is put at its place in a window of 4 bytes; windows never share a bit, so bytes are sums.
    window = codes[ids].astype(np.int64) << (32 - size - (starts & 7))
    at, total = starts >> 3, int(ends[-1])
    out = np.zeros(total + 4, np.float64)
    for k in range(4):
        out += np.bincount(at + k, (window >> (24 - 8 * k)) & 255, total + 4)
    return out[:total].astype(np.uint8).tobytes(), ends, starts


def decode(stream: bytes, offsets: np.ndarray, counts: np.ndarray, table: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    """Symbols of all segments, in order; segment i has counts[i] symbols from bit offsets[i] on. Segments are decoded in step, one symbol of each at a time."""
    top, symbols, sizes = table
    data = np.frombuffer(stream + b"\0" * 8, np.uint8).astype(np.int64)
    words = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    counts = counts.astype(np.int64)
    place = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.empty(0, np.int64)
    out = np.empty(int(counts.sum()), np.uint32)
    order = np.argsort(-counts, kind="stable")  # live segments stay in front
    bit, place, left = offsets.astype(np.int64)[order], place[order], counts[order]
    live, step = int(np.searchsorted(-left, 0)), 0
    while live:
        now = bit[:live]
        value = (words[now >> 3] >> (32 - top - (now & 7))) & ((1 << top) - 1)
        out[place[:live] + step] = symbols[value]
        now += sizes[value]
        step += 1
        live = int(np.searchsorted(-left[:live], -step))
    return out
