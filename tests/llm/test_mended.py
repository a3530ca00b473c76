"""Cases that earlier rounds got wrong."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import alike, fixity, lines, mixing, simhash, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("where", ["WARC", "response", "URI", "Record-ID", "urn", ">\r\nContent", "Length: ", "\r\n\r\n<p>"])
def test_a_damaged_header_costs_one_record(spark, tmp_path, where):
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>" * (1 + i % 3)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    own = fixity.records(pages)
    path = fixity.write_warc(pages, f"file://{tmp_path}/w")
    (file,) = tmp_path.glob("w/file=0/*.txt")
    raw = bytearray(file.read_bytes())
    begin = raw.index(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/12\r\n")
    at = raw.index(where.encode(), begin) + len(where) - (3 if where.startswith("\r\n") else 1)
    raw[at] = ord("#")
    (tmp_path / "w/file=0" / f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(raw)
    found = fixity.audit(fixity.tree(own), fixity.tree(fixity.read_warc(spark, path))).collect()
    assert [(r["file"], r["place"], r["kind"]) for r in found] == [(0, 12, "corrupt")]


def test_two_damaged_headers_and_a_wrong_length(spark, tmp_path):
    rows = [(i, f"http://a/{i}", "x" * (20 + i)) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = fixity.write_warc(pages, f"file://{tmp_path}/w")
    (file,) = tmp_path.glob("w/file=0/*.txt")
    raw = file.read_bytes().replace(b"<urn:page:7>", b"<urn:pane:7>").replace(b"<urn:page:8>", b"<urn:pane:8>").replace(b"Content-Length: 41\r\n", b"Content-Length: 14\r\n").replace(b"Content-Length: 49\r\n", b"Content-Length: 94\r\n")
    (tmp_path / "w/file=0" / f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(raw)
    found = fixity.audit(fixity.tree(fixity.records(pages)), fixity.tree(fixity.read_warc(spark, path))).collect()
    assert sorted((r["place"], r["kind"]) for r in found) == [(7, "corrupt"), (8, "corrupt"), (21, "corrupt"), (29, "corrupt")]


def test_mix_loses_no_word_to_leading_space(spark):
    rows = [(i, "\t \n" + " \t".join(f"w{i}x{j}" for j in range(3 + i % 7)) + "\r\n", "en", "abcd"[i % 4], 0) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS)
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    served, budget = mixing.served(sized)
    asked = mixing.truncated(served, budget).agg(F.sum("taken")).first()[0]
    given = mixing.mix_stage(spark, docs, "").agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert asked == given == budget


def test_equal_largest_and_null_ids(spark):
    last = 2**63 - 1
    rows = [(1, "zz"), (1, "aaa bbb ccc ddd"), (last, "the last"), (None, "no id"), (None, None), (-5, "first"), (1, "zz"), (last, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = tokens.write(df)
    out = sorted((tuple(r) for r in tokens.read(spark, path).select("start", "doc_id", "n_tokens", "ids").collect()))
    import hashlib

    md5 = lambda t: hashlib.md5((t or "").encode()).digest()
    expected = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, md5(r[1])))
    tok = tokens._tokenizer(tokens.tokenizer_path())
    at = 0
    for (start, doc_id, n, ids), (d, text) in zip(out, expected, strict=True):
        own = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        assert (start, doc_id, n) == (at, d, len(own)) and zlib.crc32(ids) == zlib.crc32(np.array(own, "<u4").tobytes())
        at += n


def test_wide_parity_parts_long_sets_and_loses_no_like_pair(spark):
    rng = np.random.default_rng(3)
    fresh = lambda n: rng.integers(0, 1 << 64, n, np.uint64)
    base = np.unique(fresh(1600))
    sets = {"base": base, "none": np.empty(0, np.uint64), "few": fresh(5), "unlike": np.union1d(fresh(1500), base[:60]), "half": np.union1d(base[:800], fresh(800))}
    sets |= {f"like{k}": np.union1d(base[k:], fresh(k)) for k in (0, 40, 100, 170)}
    sets |= {f"part{n}": base[:n] for n in (1280, 1281, 1500)}
    jaccard = lambda a, b: len(np.intersect1d(sets[a], sets[b])) / max(1, len(np.union1d(sets[a], sets[b])))
    rows = [(k.encode(), s.view(np.int64).tolist(), simhash.wide_parity(s).tolist()) for k, s in sets.items()]
    frame = spark.createDataFrame([*rows, rows[0]], "key binary, shingles array<long>, wide array<long>")
    pairs = [(a, b) for a in sets for b in sets if a < b]
    out = simhash.possible(spark.createDataFrame([(a.encode(), b.encode()) for a, b in pairs], "a binary, b binary"), frame).collect()
    kept = {(bytes(r["a"]).decode(), bytes(r["b"]).decode()) for r in out}
    alike_ = {p for p in pairs if jaccard(*p) >= 0.8}
    assert len(out) == len(kept) and alike_ <= kept and len(alike_) > 10
    assert not kept & {("base", "unlike"), ("base", "half"), ("base", "few")}
    # the sketch of 256 bits alone parts no sets as long as these
    narrow = spark.createDataFrame([(k.encode(), len(s), *simhash.parity(s).tolist()) for k, s in sets.items()], "key binary, n int, p0 long, p1 long, p2 long, p3 long")
    assert alike.able(spark.createDataFrame([(b"base", b"unlike")], "a binary, b binary"), narrow).count() == 1


def test_a_tokenizer_gets_bounded_pieces(monkeypatch):
    path, sent = tokens.tokenizer_path(), []
    known = tokens._Words(path)

    class Tokenizer:
        model = known.tok.model

        def encode_batch_fast(self, texts, **options):
            sent.append(sum(map(len, texts)))
            return plain.encode_batch_fast(texts, **options)

    plain, known.tok = known.tok, Tokenizer()
    monkeypatch.setattr(tokens, "_words", lambda at: known)
    texts = [f"wide{i}  text {i}\n " * 100 for i in range(600)] + [None, "", "a"] + [" ".join(f"w{i}x{k}," for k in range(200)) for i in range(300)]
    ids, n = tokens.encode_texts(pa.array(texts), path)
    assert max(sent) <= 2 * tokens.WHOLE < sum(map(len, texts[:600]))
    every = [[*plain.encode(t or "", add_special_tokens=False).ids, tokens.END_ID] for t in texts]
    assert n.tolist() == [len(e) for e in every]
    assert ids.tolist() == [i for e in every for i in e]


def test_long_lines_are_parted_before_they_are_compared(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63 - 1, 900)
    sets = [base, np.concatenate([base[:850], rng.integers(-(2**63), 2**63 - 1, 50)]), np.concatenate([base[:200], rng.integers(-(2**63), 2**63 - 1, 700)])]
    rows = spark.createDataFrame([(i, sorted(s.tolist())) for i, s in enumerate(sets)], "key int, shingles array<long>")
    wide = lines.widened(rows)
    for r in wide.collect():
        odd = np.bincount((sets[r["key"]].view(np.uint64) >> np.uint64(54)).astype(int), minlength=1024) & 1
        assert r["n"] == 900 and [int(v) & (2**64 - 1) for v in r["wide"]] == [sum(int(b) << k for k, b in enumerate(odd[64 * i : 64 * i + 64])) for i in range(16)]
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a int, b int")
    assert [tuple(r) for r in alike.within(pairs, wide).collect()] == [(0, 1)]


def test_lines_of_large_bands_are_met_without_writing_their_sets(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 8)))
    passage, rows = [word() for _ in range(14)], []
    for _ in range(60):  # a passage that all share, each with a near copy; then one dense group
        own = [word() for _ in range(7)]
        rows += [" ".join(own[:3] + passage + own[3:]), " ".join([*own[:3], *passage, *own[3:-1], word()])]
    base = [word() for _ in range(20)]
    for _ in range(60):
        own = [*base]
        own[rng.randrange(20)] = word()
        rows.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    written, plain = [], lines.stored

    def stored(df, name, *args, **options):
        out = plain(df, name, *args, **options)
        written.append((name, df.columns, out.count() if name == "able" else 0))  # it is deleted at the end
        return out

    monkeypatch.setattr(lines, "stored", stored)
    kept = lambda: {r["doc_id"] for r in lines.flagged(df).where("kept").collect()}
    found = kept()
    # sets of shingles take eight times the text, so none is written; a dense group isn't compared pair by pair
    assert not [name for name, columns, _ in written if "shingles" in columns]
    assert sum(n for _, _, n in written) < 3 * len(rows)
    # bands beyond HUGE lines, which the rare shingles join, give the same
    monkeypatch.setattr(lines, "HUGE", 20)
    written.clear()
    assert kept() == found and {"prefixes"} <= {name for name, _, _ in written}


def test_pairs_of_large_bands_are_told_once_by_compiled_code(spark, capsys):
    rng = np.random.default_rng(5)
    fresh = lambda n: rng.integers(-(2**63), 2**63 - 1, n)
    base = fresh(150)
    sets = [np.concatenate([base[: 60 + 2 * i], fresh(3)]) for i in range(40)]
    bands = [{b for b in range(6) if (i + b) % 5} for i in range(40)]
    wide = lines.widened(spark.createDataFrame([((i, -i), s.tolist()) for i, s in enumerate(sets)], "key struct<k1: long, k2: long>, shingles array<long>"))
    crowd = spark.createDataFrame([(i, b) for i, own in enumerate(bands) for b in own], "k1 long, band long")
    roots = spark.createDataFrame([((i, -i), (0, 0)) for i in range(10)], "node struct<k1: long, k2: long>, root struct<k1: long, k2: long>")
    odd = [np.bincount((s.view(np.uint64) >> np.uint64(54)).astype(int), minlength=1024) & 1 for s in sets]
    told = {(i, j): int((odd[i] != odd[j]).sum()) for j in range(40) for i in range(j) if bands[i] & bands[j]}
    sizes = lambda i, j: (len(sets[i]), len(sets[j]))
    may = {(*p, d) for p, d in told.items() if 5 * min(sizes(*p)) >= 4 * max(sizes(*p)) and 9 * d <= sum(sizes(*p))}
    # lines that share several bands are one pair, and united ones none
    found = lines.remaining(crowd, wide, roots)
    assert sorted((r["a"]["k1"], r["b"]["k1"], r["differ"]) for r in found.collect()) == sorted(x for x in may if x[1] >= 10)
    pairs = spark.createDataFrame([p for p in told for _ in range(2)], "a long, b long")
    able = lines.able(pairs, wide)
    assert sorted((r["a"]["k1"], r["b"]["k1"], r["differ"]) for r in able.collect()) == sorted(may)
    # Java leaves methods beyond 8,000 bytes uncompiled
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (found, able):
            capsys.readouterr()
            df.select("*").explain("codegen")
            found_sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
            assert found_sizes and max(found_sizes) < 8_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
