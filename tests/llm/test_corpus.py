"""The corpus operators against brute force, and on the cases that break things: nulls, empty and long texts, ties, repeated rows, empty tables, columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import components, decontaminate, fingerprints, fixity, huffman, licences, lines, mixing, queries, simhash, tokens, toxicity, urls

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with everything odd, and columns named like those the operators use."""
    rows = [(1, "", "en", "a", 0), (2, None, None, None, None), (3, "one two", "en", "a", 7), (4, "one two", "en", "b", 7), (4, "one two", "en", "b", 7), (None, "x  y\t\n z\n\nx  y", "en", "b", 9), (7, LONG, "en", "a", len(LONG)), (8, "all rights reserved. ALL RIGHTS RESERVED", "en", None, 40)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("size", "part", "k", "fp", "key", "target", "passes", "row", "h", "shard", "line", "node", "host", "label", "_gone")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def union(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return find


def test_components_of_chains_stars_and_repeats(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (300, 301), (301, 300)]
    df = spark.createDataFrame([*pairs, (None, 5)], "a long, b long")
    find = union(pairs)
    got = {r["node"]: r["root"] for r in components.connected_components(df).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert components.connected_components(df.where("a = 200")).count() == 0


def test_fingerprints_of_edited_texts(spark, texts):
    got = {r["doc_id"]: r for r in fingerprints.op1_fingerprints(spark, SF).collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    for i, d in enumerate(ids):
        own, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d]["fingerprint"] == fingerprints.fingerprint(own) and got[d]["edited_fingerprint"] == fingerprints.fingerprint(edited)


def test_likeness_is_near_jaccard():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    for share in (1.0, 0.9, 0.6, 0.3, 0.0):
        a = [rng.choice(words) for _ in range(800)]
        b = a[: int(800 * share)] + [rng.choice(words) for _ in range(800 - int(800 * share))]
        sets = [set(fingerprints.shingle_hashes(" ".join(x), 5, 1).tolist()) for x in (a, b)]
        real = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        assert abs(fingerprints.likeness(*(fingerprints.fingerprint(" ".join(x)) for x in (a, b))) - real) < 0.1


def test_fingerprint_cases(spark, odd, none):
    rows = fingerprints.fingerprinted(odd).collect()
    assert len(rows) == odd.count() and fingerprints.fingerprinted(none).count() == 0
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add(r["fingerprint"])
    assert by[3] == by[4] and by[1] == by[2] == {""}
    only = fingerprints.fingerprinted(odd.where("doc_id = 3")).first()
    assert only["near_next"] == 1.0


def test_simhash_is_the_majority_of_shingle_hashes():
    text = "The quick BROWN fox\tjumps  over the lazy dog the quick brown fox jumps"
    words = [w.lower() for w in text.split()]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(len(words) - 3)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.simhash(text) == bits
    assert simhash.simhash("a b") == xxhash.xxh64_intdigest(b"a b", 42) and simhash.simhash(" \n") == simhash.simhash(None) == 0


def brute(prints):
    u = np.unique(np.array(prints, np.uint64))
    return union([(int(u[i]), int(u[i + 1 + j])) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= 4)])


@pytest.mark.parametrize(("shard", "leaf"), [(10**6, 10**6), (200, 40)])
def test_forest_finds_every_link(spark, shard, leaf):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 900, dtype=np.int64).astype(np.uint64)
    near = base[:300].copy()
    for k in range(1, 6):  # at most 5 bits away, so links at 4 and misses at 5
        near ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
        base = np.concatenate([base, near])
    dense = base[0] ^ (np.uint64(1) << rng.integers(0, 64, (200, 3)).astype(np.uint64)).sum(axis=1)  # one dense group
    u = np.unique(np.concatenate([base, dense, np.zeros(1, np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in u.view(np.int64)], "fp long")
    edges = simhash.links(df, shard=shard, leaf=leaf).collect()
    assert len(edges) < 4 * 3 * len(u)
    as_unsigned = lambda v: v & (2**64 - 1)
    assert all(bin(as_unsigned(r["a"]) ^ as_unsigned(r["b"])).count("1") <= 4 for r in edges)
    got, real = union([(as_unsigned(r["a"]), as_unsigned(r["b"])) for r in edges]), brute(u)
    assert all(got(int(x)) == real(int(x)) for x in u)


def test_simhash_classes(spark, texts, odd, none):
    got = {r["doc_id"]: r for r in simhash.op2_simhash(spark, SF).collect()}
    prints = {d: simhash.simhash(t) for d, t in texts.items()}
    find, least = brute(list(prints.values())), {}
    for d in sorted(prints):
        least.setdefault(find(prints[d]), d)
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in got.items()} == {d: (f"{p:016x}", least[find(p)]) for d, p in prints.items()}
    assert simhash.classes(none).count() == 0
    assert {(r["doc_id"], r["component_id"]) for r in simhash.classes(odd).collect()} >= {(1, 1), (2, 1), (3, 3), (4, 3)}
    # rows without an id, and different texts under one id, stay apart
    apart = spark.createDataFrame([(None, "a b c d e f g"), (None, "t u v w x y z"), (5, "one two three four five six"), (5, "six five four three two one"), (5, "one two three four five six")], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "t1", "row", "n")})
    assert sorted(r["text"] for r in simhash.one_of_each(spark, apart, SF).collect()) == ["a b c d e f g", "one two three four five six", "six five four three two one", "t u v w x y z"]
    kept = simhash.one_of_each(spark, odd, SF)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "7", "8", "None"]


def test_lines(spark, odd, none):
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in lines.flagged(odd).collect()}
    assert got[(3, 0)] and not got[(4, 0)] and (None, 2) not in got and sum(v for (d, _), v in got.items() if d is None) == 2
    assert lines.flagged(none).count() == 0
    out = lines.deduplicated(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    a = "the committee agreed that every evening train should leave the eastern gate before seven thirty each weekday"
    df = spark.createDataFrame([(1, a), (2, f"head\n{a}!"), (3, a.replace("committee", "assembly of members from elsewhere").replace("train", "ferry")), (4, a + "!")], "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in lines.flagged(df).collect()}
    assert got == {(1, 0): True, (2, 0): True, (2, 1): False, (3, 0): True, (4, 0): False}
    assert {r["doc_id"]: r["text"] for r in lines.deduplicated(df).collect()}[2] == "head"


def near_documents(texts):
    """Least doc_id of each component of texts at a Jaccard similarity of 0.8 or more of 5-word shingles, by brute force."""
    sets = {d: set(simhash.shingle_hashes(t, 5, 42).tolist()) for d, t in texts.items()}
    ids = sorted(texts)
    find = union([(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] == sets[b] or (both := len(sets[a] & sets[b])) and 5 * both >= 4 * len(sets[a] | sets[b])])
    return {d for d in ids if find(d) == d}


def test_near_copies_of_documents(spark, texts, none):
    rng = random.Random(4)
    words, passage, made = [f"w{i}" for i in range(3_000)], [f"p{i}" for i in range(40)], {}
    for n in range(60):  # copies with ever more edits, about the limit; a passage that half of all share; one dense group
        own = [rng.choice(words) for _ in range(rng.randint(60, 150))] + passage * (n % 2)
        for k in range(40 if n == 0 else 4):
            x = [*own]
            for _ in range(1 if n == 0 else k):
                x[rng.randrange(len(x))] = rng.choice(words)
            made[len(made)] = " ".join(x)
    made |= {len(made) + i: t for i, t in enumerate(["", " \n", "a b c", "A  b c", "a b c d e f", "x y z a b"])}
    for docs in (made, texts):
        df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
        assert {r["doc_id"] for r in simhash.one_of_each(spark, df, SF).collect()} == near_documents(docs)
    assert simhash.near_classes(none).count() == 0


def test_lines_of_repeated_rows_and_ids(spark):
    rows = [(5, "first line of all\nonly here and nowhere else"), (5, "first line of all\nanother line that is alone"), (None, "lines of a row\nwithout an id"), (8, "twice the same row\nwith two lines"), (8, "twice the same row\nwith two lines"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_lines"], r["n_kept"], r["dropped"]) for r in lines.counted(df).collect())
    assert got == [("5", 2, 1, [0]), ("5", 2, 2, []), ("8", 2, 0, [0, 1]), ("8", 2, 2, []), ("9", 0, 0, []), ("None", 2, 2, [])]
    out = sorted((str(r["doc_id"]), r["text"], r["more"]) for r in lines.deduplicated(df.withColumn("more", F.lit("x"))).collect())
    assert [o[0] for o in out] == ["5", "5", "8", "8", "9", "None"]
    kept = [line for o in out if o[1] for line in o[1].split("\n")]
    assert sorted(kept) == sorted({line for _, x in rows if x for line in x.split("\n")})


@pytest.mark.parametrize("edits", [2, 3, 4])
def test_lines_of_a_large_group(spark, edits):
    """One line and 300 variants of it, among others: what brute force drops is dropped, whatever the size of the group."""
    rng = random.Random(edits)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 8))) for _ in range(2_000)]
    base, rows = [rng.choice(vocabulary) for _ in range(20)], []
    for _ in range(300):
        x = [*base]
        for _ in range(edits):
            x[rng.randrange(20)] = rng.choice(vocabulary)
        rows.append(" ".join(x))
    rows += [" ".join(rng.choice(vocabulary) for _ in range(15)) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    kept, least = {r["doc_id"] for r in lines.flagged(df).where("kept").collect()}, near_lines(rows)
    assert least <= kept and len(rows) - len(kept) >= 0.97 * (len(rows) - len(least))


def near_lines(rows, met=lambda i, j: True):
    """Least row of each component of rows (texts) at a Jaccard similarity of 0.8 or more of 5-character shingles, by brute force over the pairs that met allows."""
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i] == rows[j] or (both := len(sets[i] & sets[j])) and 5 * both >= 4 * len(sets[i] | sets[j]) and met(i, j)]
    find = union(pairs)
    return {i for i in range(len(rows)) if find(i) == i}


@pytest.mark.parametrize("shared", [8, 12, 14])
def test_lines_that_share_a_long_passage(spark, shared):
    rng = random.Random(shared)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 8)))
    vocabulary, passage, rows = [word() for _ in range(2_000)], [word() for _ in range(shared)], []
    for _ in range(400):
        own = [rng.choice(vocabulary) for _ in range(20 - shared)]
        edited = [*own]
        edited[rng.randrange(len(own))] = rng.choice(vocabulary)
        rows += [" ".join(own[:3] + passage + own[3:]), " ".join(edited[:3] + passage + edited[3:])]
    rng.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = lines.occurrences(df)
    of = {(r["k1"], r["k2"]): set(r["bands"]) for r in lines.banded(lines.sketched(found)).collect()}
    bands = {r["doc_id"]: of[r["k1"], r["k2"]] for r in found.collect()}
    kept = {r["doc_id"] for r in lines.flagged(df).where("kept").collect()}
    # every pair that shares a band is found, however large the band; nothing goes that brute force keeps
    assert near_lines(rows) <= kept <= near_lines(rows, lambda i, j: bool(bands.get(i, set()) & bands.get(j, set())))


def test_lines_at_the_limit_share_a_band(spark):
    rng = random.Random(100)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 8)))
    vocabulary, rows = [word() for _ in range(2_000)], []
    for _ in range(700):
        own = [rng.choice(vocabulary) for _ in range(20)]
        edited = [*own]
        edited[rng.randrange(20)] = rng.choice(vocabulary)
        rows += [" ".join(own), " ".join(edited)]
    rng.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    kept = {r["doc_id"] for r in lines.flagged(df).where("kept").collect()}
    least = near_lines(rows)
    assert least <= kept and len(kept - least) <= 2


def test_lines_with_few_shingles(spark):
    rows = ["abcdefgh", "abcdefghi", "-----", "----------", "=-" * 10, "=-" * 30, "tiny", "tinz", "abcdefgx"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r["doc_id"] for r in lines.flagged(df).where("kept").collect()} == near_lines(rows) == {0, 2, 4, 6, 7, 8}


def test_huffman_round_trip():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.2, 50_000), 40_000).astype(np.int64)
    counts = np.bincount(ids)
    counts[7] = 10**12  # forces the limit
    lengths = huffman.code_lengths(counts, 16)
    assert lengths.max() <= 16 and sum(2.0 ** -lengths[lengths > 0].astype(float)) <= 1
    codes, _ = huffman.canonical(lengths)
    stream, starts = huffman.encode(ids, codes, lengths)
    marks = starts[:: huffman.STRIDE]
    sizes = np.diff(np.append(np.arange(0, len(ids), huffman.STRIDE), len(ids)))
    assert (huffman.decode(stream, marks, sizes, huffman.decode_table(lengths)) == ids).all()
    # any stretch alone
    assert (huffman.decode(stream, marks[5:6], sizes[5:6], huffman.decode_table(lengths)) == ids[5 * 256 : 6 * 256]).all()
    assert huffman.code_lengths(np.array([0, 3])).tolist() == [0, 1] and huffman.code_lengths(np.zeros(3, int)).tolist() == [0, 0, 0]


def test_token_files(spark, texts, odd, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.tokenizer_path())
    encode = lambda t: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
    got, before = {r["doc_id"]: r for r in tokens.op4_token_ids(spark, SF).collect()}, 0
    for d in sorted(texts):
        ids = encode(texts[d])
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (before, len(ids), zlib.crc32(ids.tobytes()))
        before += len(ids)
    hard = ["a  b", "a   b", " x", "x ", "a\n b", "a \nb", "", "\n", " ", "it's <|endoftext|> ok  z", "it's <|endoftext|> ok z", "a<|endoftext|>b", "\nab c\nD, e\n", "\n\nq", "a.\n1b z", "é\nÉ. ü", "a \u2028b", "don't\nDon't", "\u0120x", "a\tb c\rd", "é ü ñandú, Straße!", None, "a  b", "x, y; z? 12a! n's"]
    df = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in tokens.read(spark, tokens.write(df)).collect()}
    assert all(bytes(rows[i]["ids"]) == encode(t).tobytes() for i, t in enumerate(hard))
    assert tokens.read(spark, tokens.write(none), digest=True).count() == 0
    rows = tokens.read(spark, tokens.write(odd)).collect()
    assert len(rows) == odd.count() and sorted(r["start"] for r in rows)[0] == 0


def test_fixity(spark, odd):
    pages = spark.createDataFrame([(i, f"http://a/{i}", "é" * (i % 7)) for i in range(0, 3000, 3)] + [(None, None, None), (3, "dup", "x")], "page_id long, url string, html string").withColumn("hash", F.lit("clash"))
    mine = fixity.tree(fixity.records(pages))
    assert fixity.audit(mine, mine).count() == 0
    found = fixity.audit(mine, fixity.tree(fixity.records(pages, F.col("page_id").isin(9, 2700)))).collect()
    own = fixity.records(pages).where("page_id IN (9, 2700)").collect()
    assert sorted((r["file"], r["place"]) for r in found) == sorted((r["file"], r["place"]) for r in own) and {r["kind"] for r in found} == {"corrupt"}
    short = fixity.audit(mine, fixity.tree(fixity.records(pages.where("NOT page_id <=> 2997"))))
    assert [(r["other_hash"]) for r in short.collect()] == [None]
    assert fixity.tree(fixity.records(pages.limit(0))).nodes.count() == 0


def test_fixity_finds_holes_and_moved_records(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", "x" * (i % 11)) for i in range(300)], "page_id long, url string, html string")
    own = fixity.records(pages)
    mine = fixity.tree(own)
    one = fixity.audit(mine, fixity.tree(fixity.records(pages.where("page_id <> 17")))).collect()
    assert [(r["place"], r["kind"]) for r in one] == [(17, "missing")]
    back = fixity.audit(fixity.tree(fixity.records(pages.where("page_id <> 17"))), mine).collect()
    assert [(r["place"], r["kind"]) for r in back] == [(17, "extra")]
    # record 40 lies after record 200 in the other replica, whose bytes between are further on
    rows = [r.asDict() for r in own.orderBy("start").collect()]
    moved = [r for r in rows if r["page_id"] != 40]
    moved.insert(200, rows[40])
    at = 0
    for r in moved:
        r["start"], at = at, at + r["length"]
    found = fixity.audit(mine, fixity.tree(spark.createDataFrame(moved, own.schema))).collect()
    assert [(r["place"], r["kind"]) for r in found] == [(40, "moved")]


def test_fixity_of_a_hot_file(spark, monkeypatch):
    rows = [(7, f"http://a/{i % 40}", "x" * (i % 40)) for i in range(400)] + [(i, "u", "y") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    plain = sorted(map(tuple, fixity.records(pages).collect()))
    monkeypatch.setattr(fixity, "HOT", 100)
    assert sorted(map(tuple, fixity.records(pages).collect())) == plain


def test_warc_files(spark, tmp_path):
    rows = [(i, f"http://a/{i}", "<p>é\r\n\r\n</p>" * (i % 5)) for i in range(1200)] + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    own = fixity.records(pages)
    path = fixity.write_warc(pages, f"file://{tmp_path}/w")
    assert sorted(map(str, fixity.read_warc(spark, path).collect())) == sorted(map(str, own.collect()))
    files = sorted(tmp_path.glob("w/file=1/*.txt"))
    raw = bytearray(files[0].read_bytes())
    assert len(files) == 1 and raw.startswith(b"WARC/1.0\r\n") and raw.endswith(b"\r\n\r\n")
    raw[raw.index(b"http://a/600") + 9] = ord("7")
    (tmp_path / "w/file=1" / f".{files[0].name}.crc").unlink(missing_ok=True)
    files[0].write_bytes(raw)
    found = fixity.audit(fixity.tree(own), fixity.tree(fixity.read_warc(spark, path))).collect()
    assert [(r["file"], r["place"], r["kind"]) for r in found] == [(1, 600 - 512, "corrupt")]


def test_mixing(spark, odd, none):
    rows, budget = mixing.served(spark.createDataFrame([(i, "abc"[i % 3], 10 * (i % 5)) for i in range(300)], "doc_id long, source string, size long"))
    per, words = defaultdict(lambda: [0, 0.0, 0]), defaultdict(int)
    taken = mixing.truncated(rows, budget).collect()
    for r in taken:
        assert 0 <= r["taken"] <= r["words"]
        per[r["source"]][0] += r["taken"]
        per[r["source"]][1], per[r["source"]][2] = r["target"], r["source_size"]
        words[r["doc_id"], r["pass"]] += r["words"]
    assert sum(r["taken"] for r in taken) == budget and all(n == 10 * (i % 5) for (i, _), n in words.items())
    # the cut is one place of the global order: all before it is taken whole, nothing after it
    order = sorted(taken, key=lambda r: (r["finish"], r["queue"], r["begin"]))
    full = [r["taken"] == r["words"] for r in order]
    assert full == sorted(full, reverse=True) and sum(0 < r["taken"] < r["words"] for r in taken) <= 1
    assert all(t - 1 <= got <= t and t <= 3 * size for got, t, size in per.values())
    sizes = spark.createDataFrame([("a", 10), ("b", 100), (None, 1000)], "source string, source_size long")
    # a stops at 3 * 10, b at 3 * 100, the null source takes the rest
    assert {r["source"]: r["target"] for r in mixing.targets(sizes).collect()} == {"a": 30.0, "b": 300.0, None: 780.0}
    assert mixing.served(none.withColumn("size", F.lit(1)))[0].count() == 0
    out = mixing.mix_stage(spark, odd, SF)
    assert out.columns == odd.columns and out.count() > 0
    assert mixing.mix_stage(spark, none, SF).count() == 0


def test_mix_stage_is_the_mix(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r["doc_id"]: r["taken"] for r in mixing.op6_mixing(spark, SF).collect()}
    got = defaultdict(int)
    for r in mixing.mix_stage(spark, docs, SF).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        assert words == re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]])[: len(words)] and r["n_chars"] == len(r["text"])
        got[r["doc_id"]] += len(words)
    assert got == {d: n for d, n in want.items() if n}


def test_licences(spark, odd, none):
    df = spark.createDataFrame([(1, "Licensed under CC BY-NC 4.0. cc by cc by"), (2, "x licensed under the Apache License, Version 2.0, y"), (3, "apache was a license of version 2 0"), (4, "GNU General Public License, version 3")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licences.scanned(df).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["labels"]) == (3, 2, 9, "cc-by,cc-by-nc-4.0")
    assert got[2]["labels"] == "apache-2.0" and got[2]["base_labels"] == "" and got[3]["labels"] == "" and got[4]["labels"] == "gpl,gpl-3.0"
    rows = {r["doc_id"]: r for r in licences.scanned(odd).collect()}
    assert (rows[8]["n_base"], rows[8]["first_word"], rows[8]["last_word"], rows[8]["base_labels"]) == (2, 0, 3, "reserved")
    assert rows[2]["n_words"] == 0 and rows[2]["first_word"] is None and rows[2]["labels"] == "" and licences.scanned(none).count() == 0


def test_licence_words_and_places_by_brute_force(spark, texts):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in licences.op7_licences(spark, SF).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r["doc_id"]].translate(fold))
        places = [i for p in licences.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(places, default=None), max(places, default=None))


def test_toxicity_learns_a_rare_expression(spark, none):
    rng = random.Random(3)
    syllables = ["ta", "ri", "mo", "le", "su", "ken", "dor", "pa", "vi", "no"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(rng.randint(20, 120))]
        if toxic := i % 4 == 0:
            for _ in range(1 + len(words) // 40):
                words[rng.randrange(len(words))] = rng.choice(["gruzbat", "gruzkin", "skwelch"]) + rng.choice(syllables)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, known).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.97
    empty = toxicity.scored(docs.limit(2).unionByName(spark.createDataFrame([(None, None, "c")], "doc_id long, text string, key string")), known.limit(0)).collect()
    assert [r["score"] for r in empty] == [0.0, 0.0, 0.0]
    assert toxicity.scored(none, known).count() == 0


def test_urls(spark):
    rows = [(1, "http://a.org/x", '<link rel="canonical" href="http://b.net/fr/1">'), (2, "http://c.org/y", '<META content="0;url=/z" http-equiv=refresh>'), (3, "http://c.org/z", None), (4, None, None), (5, "HTTP://D.org", "<link href=http://a.org/x rel=canonical>"), (5, "http://x.example.com/en/9?a", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "node": F.lit(1)})
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged(pages).collect())
    assert [g[0] for g in got] == [1, 2, 3, 4, 5, 5]
    assert {g[0]: g[4] for g in got if g[1] != "x.example.com"} == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "block"}
    assert (5, "x.example.com", "/en/9", "example.com/en/", "block") in got
    # an alias that is allowed explicitly takes precedence; so does a page's own rule
    more = spark.createDataFrame([("http://a.org/x", "http://www.example.com/en/ok")], "a string, b string")
    assert {r["page_id"]: r["verdict"] for r in urls.judged(pages.where("page_id = 1"), redirects=more).collect()} == {1: "allow"}
    assert urls.judged(pages.limit(0)).count() == 0


def test_decontamination_finds_edited_items(spark, odd, none):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    index = decontaminate.Index([(i, decontaminate.normal(t)) for i, t in items])
    rng = random.Random(2)
    for n, own in enumerate(index.texts):
        x = list(own)
        for _ in range(int(index.budget[n])):
            x[rng.randrange(len(x))] = "q"  # as many substitutions as the budget
        passage = decontaminate.normal("".join(x))
        assert n in {r[0] for r in decontaminate.regions(f"some words before {passage} and after", index)}
    rows = decontaminate.contaminated(odd, spark.createDataFrame([(1, "One Two!"), (2, None), (3, "rights reserved all")], "item_id long, text string").withColumn("doc_id", F.lit(1))).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(3, 1), (4, 1), (4, 1), (8, 3)]
    assert decontaminate.contaminated(none, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert decontaminate.contaminated(odd, spark.createDataFrame([], "item_id long, text string")).count() == 0


def fewest_edits(item, every):
    """Of each place of every (code points of all texts): the fewest edits between the item and a passage that ends there."""
    row, ramp = np.zeros(len(every) + 1, np.int64), np.arange(len(every) + 1)
    for c in item:
        step = np.concatenate([[row[0] + 1], np.minimum(row[:-1] + (every != c), row[1:] + 1)])
        row = np.minimum.accumulate(step - ramp) + ramp
    return row[1:]


def test_decontamination_of_the_table(spark, texts):
    """Every item in every text by plain edit distance: the same hits with the same edits, and no others."""
    items = [(i, decontaminate.normal(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY item_id").fetchall()]
    index, ids = decontaminate.Index(items), sorted(texts)
    plain = [decontaminate.points(decontaminate.normal(texts[d])) for d in ids]
    # texts of more than 9,000 characters are left to the other test; what parts the texts costs more than any budget
    ids, plain = zip(*((d, p) for d, p in zip(ids, plain) if len(p) < 9_000))
    wall = np.full(int(index.budget.max()) + 1, 0xFFFFFFFF, np.uint32)
    every = np.concatenate([x for p in plain for x in (p, wall)])
    owner = np.repeat(np.arange(len(plain)), [len(p) + len(wall) for p in plain])
    want = {}
    for n, (i, own) in enumerate(items):
        edits = fewest_edits(decontaminate.points(own), every)
        for at in np.flatnonzero(edits <= index.budget[n]).tolist():
            key = (ids[owner[at]], i)
            want[key] = min(want.get(key, 1 << 30), int(edits[at]))
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.op10_decontaminate(spark, SF).collect() if r["doc_id"] in set(ids)}
    assert want and got == want


def test_decontamination_finds_insertions_and_deletions():
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    index, rng = decontaminate.Index([(i, decontaminate.normal(t)) for i, t in items]), random.Random(6)
    for n, own in enumerate(index.texts):
        for most in (int(index.budget[n]), int(index.budget[n]) // 2):
            x = list(own)
            for _ in range(most):
                at = rng.randrange(1, len(x) - 1)
                rng.choice([lambda: x.pop(at), lambda: x.insert(at, "q"), lambda: x.__setitem__(at, "q")])()
            text = decontaminate.normal(f"before it {''.join(x)} after it")
            real = int(fewest_edits(decontaminate.points(own), decontaminate.points(text)).min())
            found = {r[0]: r[3] for r in decontaminate.regions(text, index)}
            assert found.get(n, real if real > index.budget[n] else None) == real


def test_decontamination_in_small_steps(monkeypatch, texts):
    index = decontaminate.Index([(i, decontaminate.normal(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()])
    want = [decontaminate.regions(t, index) for t in texts.values()]
    monkeypatch.setattr(decontaminate, "MOST", 7)
    assert [decontaminate.regions(t, index) for t in texts.values()] == want


def test_decontamination_with_many_blocks(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(str, decontaminate.contaminated(docs, items).collect()))
    clean = sorted(r["doc_id"] for r in decontaminate.clean_stage(spark, docs, SF).collect())
    monkeypatch.setattr(decontaminate, "BLOCK", 2_500)
    assert sorted(map(str, decontaminate.contaminated(docs, items).collect())) == want
    assert sorted(r["doc_id"] for r in decontaminate.clean_stage(spark, docs, SF).collect()) == clean


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = con.execute(queries.ORACLE[name])
    names = [d[0] for d in found.description]
    cut = lambda v: round(v, 6) if isinstance(v, float) else v
    assert sorted(repr([cut(r[c]) for c in columns]) for r in df.collect()) == sorted(repr([cut(r[names.index(c)]) for c in columns]) for r in found.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        assert 0 < out.count()
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
            docs = out
    assert out.count() == docs.count()


def test_pipeline_stages_by_brute_force(spark, texts):
    """What each stage keeps, judged on its own input by plainer means."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert ids(toxicity.ordinary_stage(spark, docs, SF)) == sorted(d for d, s in scores.items() if s < 0.5)
    assert set(ids(simhash.one_of_each(spark, docs, SF))) == near_documents(texts)
    hits = {r["doc_id"] for r in decontaminate.op10_decontaminate(spark, SF).collect()}
    assert ids(decontaminate.clean_stage(spark, docs, SF)) == sorted(set(texts) - hits)
    tok = Tokenizer.from_file(tokens.tokenizer_path())
    before = 0
    for r in sorted(tokens.token_stage(spark, docs, SF).collect(), key=lambda r: r["doc_id"]):
        own = np.array([*tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (before, len(own), zlib.crc32(own.tobytes()))
        before += len(own)


def test_slices_keep_every_row():
    from tallyloom.llm.common import slices

    batch = pa.RecordBatch.from_arrays([pa.array(range(1_000)), pa.array(["x" * (i % 50) for i in range(1_000)])], names=["a", "b"])
    for size in (1, 500, 10_000, 1 << 20):
        parts = list(slices(iter([batch, batch]), size))
        assert [v for p in parts for v in p.column(0).to_pylist()] == [*range(1_000), *range(1_000)]
    assert len(list(slices(iter([batch]), 1))) == 1_000
