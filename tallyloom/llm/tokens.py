"""Token-id output: documents as Huffman-coded blocks of token ids, written and read back by Spark.

File format. A shard is one Parquet part file of the folder written; each row is an independent block of documents in ascending doc_id order: shard (its range of the global order), block (its number in the shard), doc_ids, n_null (so many ids at its end are null), n_tokens (ids of each document, end id included), bits (the block's bit stream; each document starts on a byte), checkpoints (bit offset of every STRIDE-th symbol of each document, counted from its start, in order). The code lengths lie beside the shards, as one row of bytes. Any block is decoded from its own row and the code lengths alone, and any stretch of STRIDE ids from its checkpoint.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import parts, shared_dir, slices, stored, table
from tallyloom.llm.huffman import STRIDE, canonical, code_lengths, decode, decode_table, encode_each
from tallyloom.llm.ordering import bounds, in_ranges, order_key

END_ID = 0
#: Bytes of a block's bit stream at which it is closed; words whose ids a worker remembers, and words that it learns at once.
BLOCK, WORDS, LEARNT = 1 << 18, 500_000, 1 << 14
#: Bytes of text, and ids, that are worked on at once; characters of texts that the tokenizer gets at once (one text at least), whose tokens take a hundred times as much.
STEP, IDS, WHOLE = 3 << 20, 1 << 20, 1 << 18
#: White space next to white space could make a token that spans the cut between two words.
_WIDE = r"[\s\x0b\x1c-\x1f\x85\p{Z}][\s\x0b\x1c-\x1f\x85\p{Z}]"
#: Marks that are a piece of their own after a word, if nothing follows them; how byte-level BPE writes a space, a line feed, and bytes that are no visible character.
_MARKS = (".", ",", "!", "?", ";", ":")
_SPACE, _FEED = "\u0120", "\u010a"
_BYTES = dict(zip([b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)], range(256, 512)))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Words:
    """Ids of words as the tokenizer gives them, for one worker: the known words and, by their number, each one's stretch of a pool of ids. A word that begins with a line feed stands at the start of a line, any other has a space before it. Beyond WORDS words those that came once are forgotten, or all if that isn't enough."""

    def __init__(self, path: str):
        self.tok = _tokenizer(path)
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(_SPACE)]] = True
        self.marks = {m: self.tok.token_to_id(m) for m in _MARKS}
        self.feed = [self.tok.token_to_id(_FEED)]
        self.clear()

    def clear(self) -> None:
        self.known, self.pool = pa.array([], pa.string()), np.empty(0, np.uint32)
        self.at, self.size, self.came = (np.empty(0, np.int32) for _ in range(3))

    def find(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct words; new ones are learnt."""
        found = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().copy()
        missing = np.flatnonzero(found < 0)
        if len(missing) and len(self.known) and len(self.known) + len(missing) > WORDS:
            self.came[found[found >= 0]] += 1
            self._forget(len(missing))
            return self.find(words)
        if len(missing):
            order = self._learn(words.take(pa.array(missing)))
            found[missing[order]] = np.arange(len(self.known) - len(missing), len(self.known))
        self.came[found] += 1
        return found

    def _forget(self, coming: int) -> None:
        stay = np.flatnonzero(self.came > 1)
        known, at, size, pool = self.known, self.at[stay], self.size[stay], self.pool
        self.clear()
        if len(stay) and len(stay) + coming <= WORDS:
            ends = np.cumsum(size)
            self._keep(known.take(pa.array(stay)), pool[np.repeat(at - ends + size, size) + np.arange(ends[-1])], size)
            self.came[:] = 1

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Learn words and give their places in the order in which they were numbered. A piece of them at a time: the tokenizer's own objects take far more than the ids."""
        orders, ids, sizes = zip(*(self._encoded(words.slice(at, LEARNT).to_pylist()) for at in range(0, len(words), LEARNT)))
        order = np.concatenate([own + at for own, at in zip(orders, range(0, len(words), LEARNT))])
        self._keep(words.take(pa.array(order)), np.concatenate(ids), np.concatenate(sizes))
        return order

    def _encoded(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of the words in the order in which they were encoded, ids, number of each). Letters are one piece for the tokenizer's model, and one mark after them another; other words go through the whole tokenizer."""
        tokenize, marks, flat, sizes, plain, rest = self.tok.model.tokenize, self.marks, [], [], [], []
        quick = [i for i, w in enumerate(new) if w.isascii() and w.isalpha()]
        pieces = [tokenize(_SPACE + new[i]) for i in quick]
        sizes += map(len, pieces)
        flat += [t.id for p in pieces for t in p]
        del pieces
        others = np.ones(len(new), bool)
        others[quick] = False
        for i in np.flatnonzero(others).tolist():
            core, before, ids, mark = new[i], _SPACE, [], None
            if core[:1] == "\n":
                core, before, ids = core[1:], "", self.feed
            if not core.isalpha():
                core, mark = core[:-1], marks.get(core[-1:])
                if mark is None or not core.isalpha():
                    rest.append(i)
                    continue
            ids = ids + [t.id for t in tokenize(before + (core if core.isascii() else core.encode().decode("latin-1").translate(_BYTES)))]
            if mark is not None:
                ids.append(mark)
            plain.append(i)
            flat += ids
            sizes.append(len(ids))
        lines = [i for i in rest if new[i][:1] == "\n"]
        for e in self.tok.encode_batch_fast([new[i] for i in lines], add_special_tokens=False):
            flat += e.ids
            sizes.append(len(e.ids))
        spaced = [i for i in rest if new[i][:1] != "\n"]
        ids, n = self._whole([new[i] for i in spaced])
        order = np.array(quick + plain + lines + spaced, np.int64)
        return order, np.concatenate([np.array(flat, np.uint32), ids]), np.concatenate([np.array(sizes, np.int64), n])

    def _whole(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each). Words hold no space, so in a text of all of them each space opens a word, and so does each token that begins with one."""
        if not new:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        ids = np.array(self.tok.encode_batch_fast([" " + " ".join(new)], add_special_tokens=False)[0].ids, np.uint32)
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) == len(new) and starts[0] == 0:
            return ids, np.diff(starts, append=len(ids))
        every = [e.ids for e in self.tok.encode_batch_fast([" " + w for w in new], add_special_tokens=False)]
        return np.array([i for own in every for i in own], np.uint32), np.array([len(own) for own in every], np.int64)

    def _keep(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.pool) + np.cumsum(sizes) - sizes
        self.known = pa.concat_arrays([self.known, words])
        self.pool = np.concatenate([self.pool, ids.astype(np.uint32)])
        self.at, self.size, self.came = (np.concatenate([x, y.astype(np.int32)]) for x, y in ((self.at, starts), (self.size, sizes), (self.came, np.zeros(len(sizes)))))


def _each(tok, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, one after the other; number of ids of each), WHOLE characters or one text at a time."""
    ids, sizes, some, size = [np.empty(0, np.uint32)], [], [], 0
    for i, text in enumerate(texts):
        some.append(text)
        size += len(text)
        if size >= WHOLE or i == len(texts) - 1:
            own = [np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(some, add_special_tokens=False)]
            ids.append(np.concatenate(own))
            sizes += map(len, own)
            some, size = [], 0
    return np.concatenate(ids), np.array(sizes, np.int32)


@cache
def _words(path: str) -> _Words:
    return _Words(path)


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, one after the other; number of ids of each). The end id is appended to each text; null counts as empty.

    Byte-level BPE cuts a text before each single space and around each single line feed, so a text's ids are those of its words, and each distinct word is encoded once; texts with white space next to white space are encoded whole. What the tokenizer itself takes for a special token's string is one here, too.
    """
    known = _words(path)
    texts = pc.fill_null(texts, "")
    wide = pc.match_substring_regex(texts, _WIDE)
    lists = pc.split_pattern(pc.replace_substring(pc.if_else(wide, "", texts), "\n", " \n"), " ")
    starts = lists.offsets.to_numpy()
    words = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    starts = starts - starts[0]
    which = words.indices.to_numpy()
    number = known.find(words.dictionary)
    # The first word of each text, which no space precedes (a wide text: all of it), and the end id come after the pool's.
    heads = pc.if_else(wide, texts, words.dictionary.take(pa.array(which[starts[:-1]]))).to_pylist()
    heads, sizes = _each(known.tok, heads)
    flat = np.concatenate([known.pool, heads, np.array([END_ID], np.uint32)])
    # Stretches of the ids in order: the words, an end after each text's.
    at, n = np.full(len(which) + len(texts), len(flat) - 1, np.int32), np.ones(len(which) + len(texts), np.int32)
    place = np.arange(len(which)) + np.repeat(np.arange(len(texts)), np.diff(starts))
    at[place], n[place] = known.at[number][which], known.size[number][which]
    first = starts[:-1] + np.arange(len(texts))
    at[first], n[first] = len(known.pool) + np.cumsum(sizes) - sizes, sizes
    ends = np.cumsum(n, dtype=np.int32)
    if not len(ends):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    some = n > 0
    own, last = at[some], (at + n - 1)[some]
    steps = np.ones(ends[-1], np.int32)
    steps[(ends - n)[some]] = own - np.concatenate([[0], last[:-1]])
    return flat[np.cumsum(steps, dtype=np.int32)], np.diff(ends[starts[1:] + np.arange(len(texts))].astype(np.int64), prepend=0)


def _token_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, STEP):
            ids, n = encode_texts(some.column(1), path)
            if not len(ids) or ids.max() < 1 << 16:
                raw, width, mark = ids.astype("<u2").tobytes(), 2, b""
            else:
                raw, width, mark = ids.tobytes(), 4, b"+"
            ends = (np.cumsum(n) * width).tolist()
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array([mark + raw[a:b] for a, b in zip([0, *ends], ends)], pa.binary()), some.column(2), some.column(3)], names=["k", "ids", "tie", "no_id"])

    return run


def _ids(raw: bytes) -> np.ndarray:
    """2 bytes an id; an odd length (a mark and 4 bytes an id) where an id needs more."""
    return np.frombuffer(raw, "<u4", offset=1) if len(raw) % 2 else np.frombuffer(raw, "<u2")


def _joined(batch: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, number of each document's) of some documents at a time, IDS ids or one document."""
    held, size = [], 0
    for raw in batch:
        own = _ids(raw.as_py())
        if held and size + len(own) > IDS:
            yield np.concatenate(held), np.array([len(h) for h in held], np.int64)
            held, size = [], 0
        held.append(own)
        size += len(own)
    if held:
        yield np.concatenate(held), np.array([len(h) for h in held], np.int64)


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in slices(batches):
        for ids, _ in _joined(batch.column(0)):
            own = np.bincount(ids, minlength=len(total))
            own[: len(total)] += total
            total = own
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def _encoder(lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lengths.value
        codes, _ = canonical(own)
        for batch in slices(batches):
            number, bits, marks = [], [], []
            for ids, n in _joined(batch.column(1)):
                stream, ends, starts = encode_each(ids, n, codes, own)
                before = np.concatenate([[0], ends[:-1]])
                firsts = np.cumsum(n) - n
                number.append(n)
                bits += [stream[a:b] for a, b in zip(before.tolist(), ends.tolist(), strict=True)]
                marks += [(starts[a : a + k : STRIDE] - 8 * b).astype("<i8").tobytes() for a, k, b in zip(firsts.tolist(), n.tolist(), before.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*number, np.empty(0, np.int64)])), pa.array(bits, pa.binary()), pa.array(marks, pa.binary()), batch.column(2), batch.column(3)], names=["k", "n", "bits", "marks", "tie", "no_id"])

    return run


BLOCKS = "shard int, block int, first long, doc_ids binary, n_null int, n_tokens binary, bits binary, checkpoints binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "block", "first", "doc_ids", "n_null", "n_tokens", "bits", "checkpoints"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), *[pa.binary()] * 3]
    keys, counts, bits, marks, size, block, first, shard, nulls = [], [], [], [], 0, 0, 0, None, 0

    def closed() -> pa.RecordBatch:
        row = (shard, block, first, np.array(keys, "<i8").tobytes(), nulls, np.array(counts, "<i8").tobytes(), b"".join(bits), b"".join(marks))
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    for batch in slices(batches):
        for part, k, n, own, mark, no_id in zip(*(batch.column(c).to_pylist() for c in ("part", "k", "n", "bits", "marks", "no_id")), strict=True):
            if keys and (size >= BLOCK or part != shard):
                yield closed()
                first, block = (first + sum(counts), block + 1) if part == shard else (0, 0)
                keys, counts, bits, marks, size, nulls = [], [], [], [], 0, 0
            shard = part
            nulls += no_id
            keys.append(k)
            counts.append(n)
            bits.append(own)
            marks.append((np.frombuffer(mark, "<i8") + 8 * size).astype("<i8").tobytes())
            size += len(own)
    if keys:
        yield closed()


def write(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> str:
    """Encode docs (doc_id, text; others are ignored) and write them to path (default: a new folder in the shared one); returns path.

    Rows are in ascending doc_id order, null ids last, equal ids by the md5 of their text; null texts count as empty and give just the end id; an empty table gives no blocks. The ids are written once (2 bytes each) for the global counts; they are Huffman-coded where they lie and only the coded documents are dealt out by range.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    text = F.col("text").cast("string")
    rows = docs.select(order_key().alias("k"), text.alias("text"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("tie"), F.col("doc_id").isNull().alias("no_id"))
    raw = stored(rows.mapInArrow(_token_rows(tokenizer or tokenizer_path()), "k long, ids binary, tie binary, no_id boolean"), "ids", compression="zstd")
    counts = raw.select("ids").mapInArrow(_histogram, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # a row for each id of the vocabulary
    total = np.zeros(max((r["id"] for r in counts), default=0) + 1, np.int64)
    for r in counts:
        total[r["id"]] = r["n"]
    lengths = code_lengths(total)
    coded = raw.mapInArrow(_encoder(spark.sparkContext.broadcast(lengths)), "k long, n long, bits binary, marks binary, tie binary, no_id boolean")
    dealt = in_ranges(coded, "k", bounds(raw, "k", parts(spark)), "no_id", "tie")
    dealt.mapInArrow(_blocks, BLOCKS).write.option("compression", "none").parquet(f"{path}/shards")
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/code")
    return path


def _reader(lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = decode_table(lengths.value)
        for batch in slices(batches):
            for shard, first, keys, nulls, n, bits, marks in zip(*(batch.column(c) for c in ("shard", "first", "doc_ids", "n_null", "n_tokens", "bits", "checkpoints")), strict=True):
                keys, n = np.frombuffer(keys.as_py(), "<i8"), np.frombuffer(n.as_py(), "<i8")
                offsets = np.frombuffer(marks.as_py(), "<i8")
                stretches = (n + STRIDE - 1) // STRIDE
                sizes = np.full(len(offsets), STRIDE, np.int64)
                sizes[np.cumsum(stretches) - 1] = n - (stretches - 1) * STRIDE
                ids = decode(bits.as_py(), offsets, sizes, coder).astype("<u4").tobytes()
                ends = np.cumsum(n)
                raw = [ids[4 * a : 4 * b] for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, mask=np.arange(len(n)) >= len(n) - nulls.as_py()), pa.array(np.full(len(n), shard.as_py(), np.int32)), pa.array(first.as_py() + ends - n), pa.array(n), pa.array(raw, pa.binary())], names=["k", "shard", "start", "n_tokens", "ids"])

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        crc = [zlib.crc32(raw.as_py()) for raw in batch.column(4)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())], names=["k", "shard", "start", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit integers), or with digest instead of ids their ids_crc32."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/shards")
    lengths = np.frombuffer(spark.read.parquet(f"{path}/code").first()[0], np.uint8)
    run = _reader(spark.sparkContext.broadcast(lengths))
    shards = blocks.select("shard", "n_tokens").mapInArrow(_shard_sizes, "shard int, n long").groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()  # a row a shard
    offsets, before = [], 0
    for r in shards:
        offsets.append((r["shard"], before))
        before += r["n"]
    if digest:
        docs = blocks.mapInArrow(lambda b: _digest(run(b)), "k long, shard int, start long, n_tokens long, ids_crc32 long")
    else:
        docs = blocks.mapInArrow(run, "k long, shard int, start long, n_tokens long, ids binary")
    docs = docs.join(F.broadcast(spark.createDataFrame(offsets, "shard int, before long")), "shard")
    return docs.select(F.col("k").alias("doc_id"), (F.col("start") + F.col("before")).alias("start"), "n_tokens", docs.columns[4])


def _shard_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n = [int(np.frombuffer(b.as_py(), "<i8").sum()) for b in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["shard", "n"])


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files read back."""
    return read(spark, write(table(spark, sf_dir, "documents")), digest=True)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: write the token files of docs and return a row per document from them."""
    return read(spark, write(docs), digest=True)
