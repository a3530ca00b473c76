"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A text's bytes get a label string: a byte at which a token of A ends, one of B, both, or none. A regular expression scans it for spans up to each both-label; a span is a group, and the labels in it say how many tokens of A and of B the group has. The tokens that end at a both-label are linked.

Neither tokenizer joins what lies before a space and a word after it (for B its pieces are looked through; for A its pre-tokenizer cuts there), so a text's label string is that of its words, one after the other, and a worker scans each distinct word once; texts with white space next to white space are cut at their single spaces only. What the tables of a tokenizer don't allow to be cut is scanned whole.

How many pairs of ids can be linked is bounded by the vocabularies: the shorter token is the end of the longer one. So the counts of pairs, summed over the corpus by Spark, are broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import slices, stored, table

#: Bytes of text that are worked on at once; words that a worker remembers; counts of pairs that a task holds before it sums them up.
STEP, WORDS, HELD = 4 << 20, 600_000, 1 << 20
#: White space next to white space, where a token could span a cut; a single space between other characters.
_WIDE = r"[\s\x0b\x1c-\x1f\x85\p{Z}][\s\x0b\x1c-\x1f\x85\p{Z}]"
_BLANK = re.compile(r"[\s\x1c-\x1f\x85]")
#: Words that are encoded as one text, which is cut again where tokens begin with a space.
_RUN = 1000
_SINGLE = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")
#: Labels: none, A ends, B ends, both end.
_NONE, _A, _B, _BOTH = b".abx"
_GROUP = re.compile(rb"[^x]*x")
#: How byte-level entries write the bytes that are no visible character.
_VISIBLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE_OF = {chr(b): b for b in _VISIBLE} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(_VISIBLE))}


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def labelled(a_ends: np.ndarray, b_ends: np.ndarray, size: int) -> bytes:
    """The label string of size bytes by the ends of tokens (places after them)."""
    out = np.full(size, _NONE, np.uint8)
    out[a_ends - 1] = _A
    both = out[b_ends - 1] == _A
    out[b_ends - 1] = np.where(both, _BOTH, _B)
    return out.tobytes()


def grouped(labels: bytes) -> np.ndarray:
    """end, tokens of A, tokens of B (rows) of each span up to a both-label."""
    ends = np.cumsum(np.fromiter(map(len, _GROUP.findall(labels)), np.int64))
    every = np.frombuffer(labels, np.uint8)
    counts = [np.diff(np.cumsum((every == own) | (every == _BOTH))[ends - 1], prepend=0) for own in (_A, _B)]
    return np.column_stack([ends, *counts]).reshape(-1, 3)


class _Pair:
    """The two tokenizers, with the bytes of each token."""

    def __init__(self, a: str, b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for text, i in entries.items():
            self.a_bytes[i] = bytes(_BYTE_OF[c] for c in text) if all(c in _BYTE_OF for c in text) else text.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in every], np.int64) for every in (self.a_bytes, self.b_bytes))
        self.blank = self.b.piece_to_id("▁")
        self.cuts = self.blank != self.b.unk_id() and not any(re.search("[^▁]▁", p) or "\n" in p for p in pieces)
        self.wide = len(pieces)
        self.opens = np.array([x[:1] == b" " for x in self.a_bytes])
        self.a_arrow, self.b_arrow = (pa.array(x, pa.binary()) for x in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = (pa.array([str(i) for i in range(len(x))]) for x in (self.a_bytes, self.b_bytes))

    def _ids_of_a(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, number of each). Units of a space and no other white space are encoded many at a time."""
        own, plain = [None] * len(units), [i for i, u in enumerate(units) if len(u) > 1 and u[0] == " " and not _BLANK.search(u, 1)]
        runs = [plain[at : at + _RUN] for at in range(0, len(plain), _RUN)]
        for run, e in zip(runs, self.a.encode_batch_fast(["".join([units[i] for i in run]) for run in runs], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.int64)
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(run) and starts[0] == 0:
                for i, part in zip(run, np.split(ids, starts[1:]), strict=True):
                    own[i] = part
        rest = [i for i, x in enumerate(own) if x is None]
        for i, e in zip(rest, self.a.encode_batch_fast([units[i] for i in rest], add_special_tokens=False), strict=True):
            own[i] = np.array(e.ids, np.int64)
        return np.concatenate([*own, np.empty(0, np.int64)]), np.array([len(x) for x in own], np.int64)

    def _ids_of_b(self, units: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """texts: what is encoded for each unit; a space is put before it, which isn't there where a unit begins a line."""
        own = [y[1:] if u[:1] == "\n" else y if t else [self.blank] for u, t, y in zip(units, texts, self.b.encode(texts, num_threads=1), strict=True)]
        return np.array([i for y in own for i in y], np.int64), np.array([len(y) for y in own], np.int64)

    def scanned(self, units: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A; ids of B; tokens of A, of B and groups of each unit, and whether its bytes aren't given back; tokens of A and of B, and the end, of each group). Units whose bytes aren't given back have no tokens."""
        raw = pa.array(units).cast(pa.binary())
        size = pc.binary_length(raw).to_numpy().astype(np.int64)
        (x, nx), (y, ny) = self._ids_of_a(units), self._ids_of_b(units, texts)
        bad = np.zeros(len(units), bool)
        for ids, n, sizes, entries in ((x, nx, self.a_size, self.a_arrow), (y, ny, self.b_size, self.b_arrow)):
            whole = np.concatenate([[0], np.cumsum(sizes[ids])])
            ends = np.cumsum(n)
            bad |= whole[ends] - whole[ends - n] != size
            text = b"".join(entries.take(pa.array(ids)).to_pylist())
            if text != b"".join(raw.to_pylist()):
                for i, (a, b) in enumerate(zip(whole[ends - n].tolist(), whole[ends].tolist(), strict=True)):
                    bad[i] |= text[a:b] != raw[i].as_py()
        if bad.any():
            x, y = x[~np.repeat(bad, nx)], y[~np.repeat(bad, ny)]
            nx, ny, size = np.where(bad, 0, nx), np.where(bad, 0, ny), np.where(bad, 0, size)
        labels = labelled(np.cumsum(self.a_size[x]), np.cumsum(self.b_size[y]), int(size.sum()))
        groups = grouped(labels)
        edges = np.concatenate([[0], groups[:, 0]])
        found = np.diff(np.searchsorted(edges[1:], np.concatenate([[0], np.cumsum(size)]), side="right"))
        return x, y, np.column_stack([nx, ny, found, bad]), groups[:, 1:], groups[:, 0]


@cache
def _pair(a: str, b: str) -> _Pair:
    return _Pair(a, b)


class _Words:
    """What a worker knows of words: numbers of tokens and groups, the groups as text, and linked pairs (A's id times B's entries, plus B's id) as a stretch of a pool. A word that begins with a line feed begins a line, any other has a space before it."""

    def __init__(self, pair: _Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.known, self.texts = pa.array([], pa.string()), pa.array([], pa.string())
        self.counts, self.at, self.pool = np.empty((0, 4), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def find(self, words: pa.Array) -> np.ndarray:
        if len(self.known) > WORDS:
            self.clear()
        found = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().copy()
        missing = np.flatnonzero(found < 0)
        if len(missing):
            found[missing] = len(self.known) + np.arange(len(missing))
            new = words.take(pa.array(missing))
            texts = new.to_pylist()
            self._learn([t if t[:1] == "\n" else " " + t for t in texts], texts)
            self.known = pa.concat_arrays([self.known, new])
        return found

    def once(self, texts: list[str]) -> np.ndarray:
        """Numbers of whole texts, which aren't looked up again."""
        first = len(self.at)
        self._learn([" " + t for t in texts], texts)
        self.known = pa.concat_arrays([self.known, pa.array([None] * len(texts), pa.string())])
        return first + np.arange(len(texts))

    def _learn(self, units: list[str], texts: list[str]) -> None:
        pair = self.pair
        x, y, own, sizes, _ = pair.scanned(units, texts)
        listed = lambda ids, names, n: pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), names.take(pa.array(ids))), ",")
        groups = pc.binary_join_element_wise(listed(x, pair.a_names, sizes[:, 0]), listed(y, pair.b_names, sizes[:, 1]), "|")
        strings = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(own[:, 2])]), pa.int32()), groups), ";")
        codes = x[np.cumsum(sizes[:, 0]) - 1] * pair.wide + y[np.cumsum(sizes[:, 1]) - 1]
        self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(own[:, 2]) - own[:, 2]])
        self.pool = np.concatenate([self.pool, codes])
        self.counts = np.concatenate([self.counts, own])
        self.texts = pa.concat_arrays([self.texts, strings])


@cache
def _words(a: str, b: str) -> _Words:
    return _Words(_pair(a, b))


def _cut(texts: pa.Array, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the words of all texts in order, words of each). No text is empty."""
    spaced = pc.binary_join_element_wise(" ", texts, "")
    wide = pc.match_substring_regex(spaced, _WIDE).to_numpy(zero_copy_only=False)
    whole = (wide & pc.starts_with(texts, "\n").to_numpy(zero_copy_only=False)) | (not words.pair.cuts)
    lists = pc.split_pattern(pc.replace_substring(pc.if_else(pa.array(wide | whole), "", texts), "\n", " \n"), " ").to_pylist() if (wide | whole).any() else None
    if lists is None:
        own = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        flat, n = own.values.slice(own.offsets[0].as_py(), own.offsets[-1].as_py() - own.offsets[0].as_py()), np.diff(own.offsets.to_numpy())
    else:
        for i in np.flatnonzero(wide & ~whole).tolist():
            lists[i] = _SINGLE.split(texts[i].as_py())
        flat, n = pa.array([w for own in lists for w in own], pa.string()), np.array([len(own) for own in lists], np.int64)
    flat = flat.dictionary_encode()
    number = words.find(flat.dictionary)[flat.indices.to_numpy()]
    some = np.flatnonzero(whole)
    if len(some):
        number[(np.cumsum(n) - n)[some]] = words.once([texts[i].as_py() for i in some.tolist()])
    return number, n


_DOCS = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary, times binary"


def _aligned(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(a, b)
        names = [f.split()[0] for f in _DOCS.split(", ")]
        for batch in slices(batches, STEP):
            has = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(batch.column(1)), 0), False).to_numpy(zero_copy_only=False))
            totals, digest = np.zeros((batch.num_rows, 3), np.int64), [""] * batch.num_rows
            pairs, times = [b""] * batch.num_rows, [b""] * batch.num_rows
            if len(has):
                number, n = _cut(batch.column(1).take(pa.array(has)), words)
                starts = np.concatenate([[0], np.cumsum(n)])
                sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(words.counts[number], axis=0)])
                own = sums[starts[1:]] - sums[starts[:-1]]
                good = np.flatnonzero(own[:, 3] == 0)
                totals[has[good]] = own[good, :3]
                taken = words.texts.take(pa.array(number))
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), taken), ";").cast(pa.binary())
                size = words.counts[number, 2]
                codes = words.pool[np.repeat(words.at[number] - np.cumsum(size) + size, size) + np.arange(size.sum())]
                wide = words.pair.wide * len(words.pair.a_bytes)
                doc = np.repeat(np.arange(len(has)), own[:, 2])
                every, count = np.unique(doc * wide + codes, return_counts=True)
                edges = np.searchsorted(every // wide, np.arange(len(has) + 1))
                every %= wide
                for i in good.tolist():
                    digest[has[i]] = hashlib.sha256(joined[i].as_buffer()).hexdigest()
                    p, q = edges[i], edges[i + 1]
                    pairs[has[i]], times[has[i]] = every[p:q].astype("<u4" if wide <= 1 << 32 else "<u8").tobytes(), count[p:q].astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(totals[:, i]) for i in range(3)), pa.array(digest), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())], names=names)

    return run


def _unpacked(pairs: pa.Array, times: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, their times, pairs of each row)."""
    sizes = pc.binary_length(times).to_numpy() // 4
    width = 8 if pc.sum(pc.binary_length(pairs)).as_py() == 8 * sizes.sum() and sizes.sum() else 4
    return np.frombuffer(b"".join(pairs.to_pylist()), f"<u{width}").astype(np.int64), np.frombuffer(b"".join(times.to_pylist()), "<u4").astype(np.int64), sizes


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of times by pair of a task's documents."""

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pair, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        n = np.zeros(len(pair), np.int64)
        np.add.at(n, at, np.concatenate([h[1] for h in held]))
        return pair, n

    held, size = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
    for batch in slices(batches):
        held.append(_unpacked(batch.column(0), batch.column(1))[:2])
        size += len(held[-1][0])
        if size > HELD:
            held, size = [summed(held)], 0
    pair, n = summed(held)
    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])


def _judged(counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, total, best = counts.value
        for batch in slices(batches):
            own, times, sizes = _unpacked(batch.column(5), batch.column(6))
            at = np.searchsorted(pair, own)
            ends = np.cumsum(sizes)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * total[at])]
            n = [s[ends] - s[ends - sizes] for s in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(3), *map(pa.array, n), batch.column(4)], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def measured(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of docs (doc_id, text; others are ignored).

    Links are pairs of tokens that end together, one a group; a pair's count is its links in all docs. Texts that are null, empty, or not given back byte for byte by either tokenizer have no tokens. Repeated rows stay and count each time; an empty table gives no rows. Texts are encoded once; their links are written (a few bytes each) and read twice.
    """
    spark, (first, second) = docs.sparkSession, paths()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = stored(rows.mapInArrow(_aligned(a or first, b or second), _DOCS), "links", compression="zstd")
    counts = own.select("pairs", "times").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # bounded by the vocabularies
    order = np.argsort(counts["pair"].to_numpy())
    pair, total = counts["pair"].to_numpy()[order], counts["n"].to_numpy()[order]
    entries = _pair(a or first, b or second).wide
    highest = np.zeros(entries, np.int64)
    np.maximum.at(highest, pair % entries, total)
    known = spark.sparkContext.broadcast((pair, total, total == highest[pair % entries]))
    return own.mapInArrow(_judged(known), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _spans(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a, b)
        for batch in slices(batches, STEP):
            out = []
            for text in batch.column(1).to_pylist():
                own = []
                if text:
                    x, y, _, sizes, ends = pair.scanned([" " + text], [text])
                    i = j = 0
                    for end, (p, q) in zip(ends.tolist(), sizes.tolist(), strict=True):
                        own.append({"end": end, "a": x[i : i + p], "b": y[j : j + q]})
                        i, j = i + p, j + q
                out.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.struct([("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))], names=["doc_id", "groups"])

    return run


def aligned(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """doc_id, groups of each row of docs: end (bytes of space and text up to there), a and b (ids of either tokenizer). Cases as in measured(). Texts are encoded whole."""
    first, second = paths()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_spans(a or first, b or second), "doc_id long, groups array<struct<end:long,a:array<int>,b:array<int>>>")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of every document."""
    return measured(table(spark, sf_dir, "documents"))
