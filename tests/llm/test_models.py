"""The toxicity models against a plain dictionary implementation, and licence labels against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tallyloom.llm import licences, toxicity

SF = "/root/testdata/sf0.001"


def kneser_ney(counts, order, spare, lower):
    """P(symbol | context) of a dictionary of counts of grams (tuples), with what is left going to lower (a function of context and symbol)."""
    total, off = defaultdict(int), defaultdict(float)
    for gram, n in counts.items():
        total[gram[:-1]] += n
        off[gram[:-1]] += min(n, spare)

    def p(context, symbol):
        context = context[len(context) - order + 1 :]
        if context not in total:
            return lower(context[1:], symbol)
        n = counts.get((*context, symbol), 0)
        return max(n - spare, 0) / total[context] + off[context] / total[context] * lower(context[1:], symbol)

    return p


def continued(counts):
    """The different symbols before each gram that is one symbol shorter."""
    return Counter(g[1:] for g in counts)


def spared(counts):
    once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
    return toxicity.discount(once, twice)


def grams(texts, n):
    out = Counter()
    for t in texts:
        s = toxicity.symbols(t).tolist()
        out.update(tuple(s[i : i + n]) for i in range(len(s) - n + 1))
    return out


def test_models_are_kneser_ney(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ba", "ki", "lo", "né", "ж", "7"]) for _ in range(rng.randint(1, 3)))
    made = [(" ".join(word() for _ in range(rng.randint(5, 30))), i % 3 == 0) for i in range(60)]
    corpus = [t for t, _ in made] + [" ".join(word() for _ in range(40)) for _ in range(30)]
    tables = {5: grams(corpus, 5)}
    for order in (4, 3, 2, 1):
        tables[order] = continued(tables[order + 1])
    whole = sum(tables[1].values()) + 0.5 * 128
    p = lambda context, symbol: (tables[1].get((symbol,), 0) + 0.5) / whole
    for order in (2, 3):
        p = kneser_ney(tables[order], order, spared(tables[order]), p)
    shared, models, own = p, {}, {}
    for c in (False, True):
        own[c] = grams([t for t, x in made if x == c], 5)
        four = continued(own[c])
        models[c] = kneser_ney(own[c], 5, toxicity.CLASS_DISCOUNT, kneser_ney(four, 4, toxicity.CLASS_DISCOUNT, shared))
    code = lambda g: sum(s << 7 * (len(g) - 1 - i) for i, s in enumerate(g))
    counts = spark.createDataFrame([(code(g), n) for g, n in tables[5].items()], "gram long, n long")
    rows = [(code(g), int(c), n) for c in own for g, n in own[c].items()]
    gram, toxic, n = (np.array(x) for x in zip(*rows))
    context, used, ratio = toxicity.class_model(gram, toxic, n, lambda some: toxicity.shared_model(counts, some))
    assert len(context) == len({g[:-1] for c in own for g in own[c]})
    for at in rng.sample(range(len(context)), 60):
        c = tuple(int(context[at]) >> 7 * k & 127 for k in (3, 2, 1, 0))
        for j, symbol in enumerate(used.tolist()):
            assert ratio[at, j] == pytest.approx(math.log(models[True](c, symbol)) - math.log(models[False](c, symbol)), abs=1e-4)
    # probabilities of a context add up to 1
    assert sum(models[True](c, s) for s in range(128)) == pytest.approx(1)


def test_symbols_of_other_scripts():
    a, b = toxicity.symbols("Да нет"), toxicity.symbols("ДА НЕТ")
    assert a.tolist() == b.tolist() and 0 not in a[1:3] and len(set(a.tolist())) > 4
    assert toxicity.symbols("1337")[1:-1].tolist() == [toxicity._DIGITS + d for d in (1, 3, 3, 7)]
    assert toxicity.symbols(None).tolist() == [0] == toxicity.symbols("--- ...").tolist() and toxicity.symbols("\U00020000").max() >= toxicity._OTHERS


def test_toxicity_in_another_script(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["по", "ки", "ло", "не", "ра"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(700):
        words = [word() for _ in range(rng.randint(20, 60))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(["жужжац", "щищ1337"])
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(700)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, known).collect()}
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in range(700) if zlib.crc32(str(i).encode()) % 5 == 0]) > 0.95


@pytest.mark.parametrize(("sf", "least", "most"), [("0.01", 0.6, 0.05), ("0.1", 0.85, 0.01)])
def test_held_out_texts_of_the_tables(spark, sf, least, most):
    at = f"/root/testdata/sf{sf}"
    got = {r["doc_id"]: r for r in toxicity.op8_toxicity(spark, at).collect()}
    known = [(got[d], t) for d, t in duckdb.sql(f"SELECT doc_id, toxic FROM '{at}/labels.parquet' WHERE doc_id IN (SELECT doc_id FROM '{at}/documents.parquet')").fetchall()]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for d, r in got.items())
    recall = np.mean([r["predicted"] for r, t in known if r["held_out"] and t == 1])
    alarms = np.mean([r["predicted"] for r, t in known if r["held_out"] and t == 0])
    assert recall >= least and alarms <= most


def test_measures_by_loop():
    rng = np.random.default_rng(4)
    base, number = 6, np.arange(128) % 6
    first, second, ratio = rng.integers(0, 4, base**3), rng.integers(0, 9, 4 * base + base), rng.normal(0, 2, 9 * base + base).astype(np.float32)
    for text in ("one word and another", "x", "", None, "a b c d e f g", "Ärger über tausend Wörter, 1337 mal"):
        s = toxicity.symbols(text)
        v = [float(ratio[second[first[(number[s[i]] * base + number[s[i + 1]]) * base + number[s[i + 2]]] * base + number[s[i + 3]]] * base + number[s[i + 4]]]) for i in range(len(s) - 4)]
        got = toxicity.measures(text, number, base, first, second, ratio)
        if not v:
            assert not got.any()
            continue
        gaps = [i for i, x in enumerate(s) if x == 0]
        words = [sum(v[i - 4] for i in range(max(4, a + 1), b + 1)) for a, b in zip(gaps, gaps[1:], strict=False)]
        w, best = min(8, len(v)), sorted(words, reverse=True)
        want = [*(sum(x > y for x in words) for y in toxicity.LEVELS), *(sum(max(0, x - y) for x in words) for y in toxicity.EXCESS), max(sum(v[i : i + w]) for i in range(len(v) - w + 1)) / 8, sum(v) / len(v), sum(best[:3]) / len(best[:3]), best[0], len(words)]
        assert got[: toxicity.MEASURES] == pytest.approx(want, abs=1e-4)
        assert (got[toxicity.MEASURES :] ** 2).sum() == pytest.approx(1)


def labels_by_brute_force(text):
    """Labels of all templates: at every shift (band of shifts), the template's postings that stand in the file; its phrases near the first best band."""
    words = re.sub(licences.GAP, " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")).split()
    found = set()
    for t in licences.TEMPLATES:
        step, bands = max(1, t.drift // 2), defaultdict(set)
        for i, w in enumerate(words):
            for v, p in t.postings:
                if v == w:
                    band = (i - p) // step
                    for b in (band, band - 1) if t.drift > 1 else (band,):
                        bands[b].add(p)
        best = max((len(v) for v in bands.values()), default=0)
        if best < t.least:
            continue
        start = min(b for b, v in bands.items() if len(v) == best) * step - licences.SLACK
        first = max(0, start)
        near = f" {' '.join(words[first : first + len(t.words) + t.drift + 2 * licences.SLACK])} "
        if all(f" {p} " in near for p in t.phrases):
            found.add(t.label)
    return found | {label for phrase, label in licences.BASE.items() if f" {phrase} " in f" {' '.join(words)} "}


def test_labels_by_brute_force(spark):
    rng = random.Random(11)
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    every = [" ".join(licences.TEMPLATES[i].words) for i in range(len(licences.TEMPLATES))]
    for i in range(400):  # whole templates, with words between, cut short, mixed, and several in one file
        words = rng.choice(every).split()
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(words))
            rng.choice([lambda: words.insert(at, "name"), lambda: words.pop(at) if len(words) > 3 else None, lambda: words.__setitem__(at, rng.choice(licences.LEXICON))])()
        more = rng.choice(every) if i % 3 == 0 else ""
        texts[10_000 + i] = f"Some words first. {' '.join(words[: rng.randint(3, len(words))] if i % 4 == 0 else words)} and more {more}"
    texts |= {20_000: licences.MIT, 20_001: "Copyright 2020 A. Name\n\n" + licences.BSD_2 + "\n" + licences.BSD_3, 20_002: licences.ISC.replace("THE SOFTWARE", "(c) Some One, 2011\nTHE SOFTWARE"), 20_003: licences.UNLICENSE, 20_004: None, 20_005: licences.ZLIB + licences.EPL, 20_006: "mit apache version license"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licences.scanned(df).collect()}
    want = {d: labels_by_brute_force(t) for d, t in texts.items()}
    assert {d: r["labels"] for d, r in got.items()} == {d: ",".join(sorted(x)) for d, x in want.items()}
    assert got[20_000]["labels"] == "mit" and got[20_001]["labels"] == "bsd,bsd-3-clause" and got[20_002]["labels"] == "isc" and got[20_003]["labels"] == "unlicense" and got[20_005]["labels"] == "epl-2.0,zlib" and got[20_006]["labels"] == ""
    assert sum(bool(x) for x in want.values()) > 200
