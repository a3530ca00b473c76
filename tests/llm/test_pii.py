"""Personal data against plain patterns and counts over whole texts in Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
import regex
from pyspark.sql import functions as F

from tallyloom.llm import pii

SF = "/root/testdata/sf0.001"
#: The plain patterns, as the task states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = regex.compile(r"\p{L}[\p{L}\p{N}]{2,}")


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        if not 16 <= len(digits) <= 19:
            return False
        total = 0
        for i, d in enumerate(reversed(digits)):
            d = int(d) * (1 + i % 2)
            total += d - 9 if d > 9 else d
        return total % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def base_of(text):
    out = []
    for kind, pattern in PLAIN.items():
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if passes(kind, m[0])]
    return out


def entity(kind, m):
    return f"{kind}:{m.lower() if kind == 'email' else m if kind == 'ip' else re.sub('[^0-9]', '', m)}"


def near(text, kind, start, end):
    """Terms within 8 whole words on either side, in the gap to the next match of the kind, of at most 160 signs."""
    edges = [(m.start(), m.end()) for m in re.finditer(PLAIN[kind], text)]
    low, high = max([e for _, e in edges if e <= start], default=0), min([s for s, _ in edges if s >= end], default=len(text))
    before, after = text[low:start], text[end:high]
    head, tail = regex.sub(r"[\p{L}\p{N}]+$", "", before[-160:]), regex.sub(r"^[\p{L}\p{N}]+", "", after[:160])
    head = regex.sub(r"^[\p{L}\p{N}]+", "", head) if len(before) > 160 else head
    tail = regex.sub(r"[\p{L}\p{N}]+$", "", tail) if len(after) > 160 else tail
    words = regex.findall(r"[\p{L}\p{N}]+", head)[-8:] + regex.findall(r"[\p{L}\p{N}]+", tail)[:8]
    return {w.lower() for w in words if WORD.fullmatch(w)}


def expected(rows):
    every = [t or "" for _, t in rows]
    texts, copies = set(every), Counter(every)
    base = {t: base_of(t) for t in texts}
    words = {t: {m[0].lower() for m in WORD.finditer(t)} for t in texts}
    holds, both = defaultdict(set), defaultdict(set)
    for t, spans in base.items():
        for kind, a, b in spans:
            e = entity(kind, t[a:b])
            holds[e].add(t)
            for w in near(t, kind, a, b):
                both[w, e].add(t)
    count = lambda some: sum(copies[t] for t in some)
    told = defaultdict(set)
    for (w, e), some in both.items():
        n_t, n_c = count(t for t in texts if w in words[t]), count(holds[e])
        if len(some) >= 2 and n_t and n_c < len(every) and math.log(len(every) * count(some) / (n_t * n_c)) / math.log(len(every) / n_c) >= 0.8:
            told[e].add(w)
    out = []
    for d, t in rows:
        t = t or ""
        reveal = set().union(*(told[entity(k, t[a:b])] for k, a, b in base[t])) if base[t] else set()
        terms = [("term", m.start(), m.end()) for m in WORD.finditer(t) if m[0].lower() in reveal and not any(a < m.end() and m.start() < b for _, a, b in base[t])]
        say = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        out.append((d, *(sum(k == kind for k, _, _ in base[t]) for kind in PLAIN), hashlib.sha256(say(base[t]).encode()).hexdigest(), say(base[t] + terms)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")) for r in df.collect()), key=repr)


ODD = [
    None, "", "a@b.c", "x a@b.c_d@e.f y", "a@b..c@d.e", "é.a@b.co.uk, A@B.C", "1.2.3.4.5.6.7.8", "256.1.1.1 1.255.0.010 0001.2.3.0255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111 5500-0000-0000-0004",
    "+1 (555) 123-4567, +49 30 1234", "+1-2", "++12345678 +", "+1 555 0100 99 4111 1111 1111 1111", "12345678901234567890", "no-reply@@x.y", "😀 mail 😀 jané@x.de 😀 +4915112345678.", "%@-.-", "1.1.1.1@2.2.2.2", "a.b.c.d@e", "378282246310005 6304000000000000 6759649826438453",
]


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "mail a@b.c"), (3, "twice a@b.c"), (3, "twice a@b.c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("key", "kind", "found", "start", "end", "value", "email", "term", "size")})
    assert rows_of(pii.scanned(df)) == expected(rows)
    assert pii.scanned(df.limit(0)).count() == 0


def test_random_texts(spark):
    rng = random.Random(9)
    bits = ["a", "b.", "@", ".", "c-d", "1", "23", " ", "-", "+", "(", ")", "4111", "é", "\n", "_", "%", "255", "999", "0"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 60)))) for i in range(3000)]
    assert rows_of(pii.scanned(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


@pytest.fixture(scope="module")
def people():
    rng = random.Random(4)
    filler = [f"word{i}" for i in range(40)]
    rows = []
    for i in range(400):
        person = i % 40
        words = [rng.choice(filler) for _ in range(30)]
        if i % 3 == 0:
            words[5:5] = [f"Ann{person}", "or", f"ann{person}@mail.example", "of", f"Office{person % 10}"]
        if i % 7 == 0:
            words += [f"ann{person}", "again"]
        rows.append((i, " ".join(words)))
    return rows + [rows[0]] * 50 + [(1000, "hello Ann1 without any address")]


def test_terms_by_loops(spark, people):
    got = rows_of(pii.scanned(spark.createDataFrame(people, "doc_id long, text string")))
    assert got == expected(people)
    assert sum("term:" in r[6] for r in got) > 100
    assert [r[6] for r in got if r[0] == 1000] == [""]  # a text without an entity is left alone


def test_sanitised_texts(spark, people):
    df = spark.createDataFrame([*people, (None, None), (5, "card 4111 1111 1111 1111!")], "doc_id long, text string").withColumn("_s", F.lit("kept"))
    spans = {(r["doc_id"], r["spans"]) for r in pii.scanned(df).collect()}
    texts = dict(people)
    out = pii.sanitised(df).collect()
    assert len(out) == len(people) + 2 and {r["_s"] for r in out} == {"kept"}
    by = defaultdict(set)
    for r in out:
        by[r["doc_id"]].add(r["text"])
    assert "card [card]!" in by[5] and by[None] == {None}
    for d, told in spans:
        if d in texts and d != 5:
            (text,) = by[d]
            assert "@" not in text
            if not told:
                assert text == texts[d]
            for span in filter(None, told.split(",")):
                kind, a, b = span.split(":")
                assert kind != "term" or texts[d][int(a) : int(b)] not in text.split()


def test_documents_and_long_texts(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert rows_of(pii.op11_pii(spark, SF)) == expected(rows)
    long = [(1, "7" * 200_000), (2, "a" * 200_000), (3, "a." * 50_000 + "@" + "b." * 50_000 + "c"), (4, "a@b.c " * 5_000 + "+1 " * 20_000), (5, "1 " * 50_000), (6, "1.2." * 30_000)]
    assert rows_of(pii.scanned(spark.createDataFrame(long, "doc_id long, text string"))) == [r for r in expected_base(long)]


def expected_base(rows):
    out = []
    for d, t in rows:
        own = [(k, a, b) for k, a, b in (base_quick(t))]
        say = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        out.append((d, *(sum(k == kind for k, _, _ in own) for kind in PLAIN), hashlib.sha256(say.encode()).hexdigest(), say))
    return sorted(out, key=repr)


def base_quick(text):
    """As base_of, with repeats that never step back where the plain pattern would take time by the square."""
    quick = PLAIN | {"email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)++", "ip": r"(?<![0-9])" + PLAIN["ip"]}
    return [(kind, m.start(), m.end()) for kind, pattern in quick.items() for m in regex.finditer(pattern, text) if passes(kind, m[0])]


def test_main_path_is_native(spark):
    df = pii.scanned(spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
