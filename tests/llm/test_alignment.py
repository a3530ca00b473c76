"""Alignment of two tokenizers against a plain version that encodes whole texts and compares ends by sets."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import alignment

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def level():
    """The usual table of byte-level entries: visible bytes are themselves, the others follow from 256 on."""
    out, more = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[chr(b)] = b
        else:
            out[chr(more)] = b
            more += 1
    return out


def by_sets(a, b, text):
    """(ids of A, ids of B, groups, links) of a text, or none."""
    if not text:
        return None
    x, y, table = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), level()
    xs = [bytes(table[c] for c in a.id_to_token(i)) for i in x]
    ys = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
    if not b"".join(xs) == b"".join(ys) == (" " + text).encode():
        return None
    xe, ye = ([sum(map(len, s[: i + 1])) for i in range(len(s))] if len(s) < 500 else np.cumsum([len(t) for t in s]).tolist() for s in (xs, ys))
    shared, groups, links, i, j = sorted(set(xe) & set(ye)), [], [], 0, 0
    for end in shared:
        p, q = i, j
        while xe[i] < end:
            i += 1
        while ye[j] < end:
            j += 1
        links.append((x[i], y[j]))
        i, j = i + 1, j + 1
        groups.append((end, x[p:i], y[q:j]))
    return x, y, groups, links


def expected(a, b, rows):
    own = [(d, by_sets(a, b, t)) for d, t in rows]
    counts = Counter(link for _, o in own if o for link in o[3])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for d, o in own:
        if o is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        x, y, groups, links = o
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for _, p, q in groups)
        out.append((d, len(x), len(y), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()), key=repr)


ODD = [
    None, "", " ", "  ", "\n", "\n\n", "a", " a", "a ", "a  b", "a\nb", "a \n b", "\na b", "\n a\n\nb c", "foo\tbar baz", "tab\t\tdouble x", "<|endoftext|> and <s> </s> <unk> <0x41>", "x<|endoftext|>y", "one ▁two", "▁", "naïve café Übergröße", "ﬁ Ａ é é",
    "日本語のテキスト と 한국어", "😀 😀😀 x😀", "a b c d", "a  b", "zero\x00nul x", "it's we'll I'D", "1234567 89 3.14", "word\r\nnext line\r\n", "end\n", "trailing  ", "a\x1cb \x85 c", "  lead", "\n\nlead x y", "x" * 3000, "​ zero ﻿ bom",
]


def test_odd_texts(spark, both):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b a b"), (3, "repeat"), (3, "repeat")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("pairs", "n_a", "pair", "n")})
    got = rows_of(alignment.measured(df))
    assert got == expected(*both, rows)
    assert alignment.measured(df.limit(0)).count() == 0


def test_random_texts_and_groups(spark, both):
    rng = random.Random(11)
    bits = [" ", "  ", "\n", "\n\n", "\t", " ", "the", "Ing", "é", "ß", "ж", "123", "'s", "-", "...", "▁", "<s>", "\r", "日", "'", "ab", "XyZ"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(["", " ", ""]) for _ in range(rng.randint(1, 25)))) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(alignment.measured(df)) == expected(*both, rows)
    texts = dict(rows)
    for r in alignment.aligned(df.where("doc_id < 200")).collect():
        o = by_sets(*both, texts[r["doc_id"]])
        assert [(g["end"], list(g["a"]), list(g["b"])) for g in r["groups"]] == (o[2] if o else [])


def test_documents_and_a_long_text(spark, both, monkeypatch):
    monkeypatch.setattr(alignment, "STEP", 50_000)
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert rows_of(alignment.op12_alignment(spark, SF)) == expected(*both, rows)
    long = [(1, " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000)))]
    assert rows_of(alignment.measured(spark.createDataFrame(long, "doc_id long, text string"))) == expected(*both, long)


def test_labels_and_groups():
    assert alignment.labelled(np.array([2, 3, 6]), np.array([1, 3, 5, 6]), 6) == b"bax.bx"
    assert alignment.grouped(b"bax.bx").tolist() == [[3, 2, 2], [6, 1, 2]] and alignment.grouped(b"").tolist() == []


def test_words_are_forgotten(spark, both, monkeypatch):
    words = alignment._Words(alignment._pair(*alignment.paths()))
    monkeypatch.setattr(alignment, "WORDS", 5)
    import pyarrow as pa

    for some in (["a", "b", "c", "d", "e", "f"], ["a", "\nx"], ["f", "b"]):
        at = words.find(pa.array(some))
        assert words.known.take(pa.array(at)).to_pylist() == some
