"""Toxicity by class-conditional Kneser-Ney models of characters.

Texts become symbols: letters a-z, the Latin-1 letters, digits, letters and marks of other scripts (case folded, in OTHER groups by code point) and gaps, runs of gaps being one. Two Kneser-Ney models of order 5, one of toxic and one of ordinary texts, back off over their own continuation counts of order 4 (the different symbols before a gram) to one shared model of order 3, which backs off over order 2 to single symbols, all by continuation counts of the whole corpus. Rare expressions thus differ between the classes only as far as the labelled texts show it: the shared orders' absolute discounts come from their counts of counts, the classes' is CLASS_DISCOUNT, so what a class has seen twice or less says nothing of its own.

A word's evidence is the log-likelihood of its symbols under the toxic model less that under the ordinary one. One telling word may be chance, many are not, and how many are usual differs between languages: so numbers of words above several levels, and what they have above them, are compared with what ordinary texts of like letters (CLUSTERS of symbol frequencies) have in as many words. These, the text's mean ratio, its highest window of WINDOW symbols and its best words are the features of a logistic function, which is the score. It is fitted on labelled texts each scored by models that have not seen it (FOLDS).

What is counted in the corpus are its grams of 5 symbols, a table that grows with it and stays distributed; of the continuation counts made from it only those whose contexts the labelled texts hold reach the driver. The classes are learnt from a bounded sample: at most SAMPLE labelled texts of each class, those with the lowest hash of doc_id. Held-out rows (crc32 of doc_id as text divisible by 5) are never among them.
"""

from __future__ import annotations

import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import give_back, slices, stored, table

ORDER, SHARED, WINDOW, SAMPLE = 5, 3, 8, 4_000
CLASS_DISCOUNT, FOLDS, CLUSTERS = 2.0, 3, 8
#: Levels of a word's evidence above which words are counted, and above which what they have more is summed up; how much more a toxic text weighs in the fit.
LEVELS, EXCESS, TOXIC_WEIGHT = (2, 3, 4, 5, 6, 8), (1, 2, 3, 4), 1.5
_BITS = 7
_ALL = 1 << _BITS
#: Symbols: 0 a gap, then 26 letters, 32 Latin-1 letters, 10 digits, OTHER groups of other letters.
_LATIN, _DIGITS, _OTHERS = 27, 59, 69
OTHER = _ALL - 1 - _OTHERS
#: Symbols of text that are counted at once.
CHUNK = 1 << 22


def _symbol(c: int) -> int:
    char = chr(c)
    low = char.lower()
    code = ord(low) if len(low) == 1 else c
    if 97 <= code <= 122:
        return code - 96
    if char.isdigit() and unicodedata.digit(char, None) is not None:
        return _DIGITS + unicodedata.digit(char)
    if not (char.isalpha() or unicodedata.category(char)[0] == "M"):
        return 0
    return _LATIN + code - 0xE0 if 0xDF < code < 0x100 else _LATIN + 31 if code < 0xE0 else _OTHERS + code % OTHER


#: Symbols of the code points of the basic plane; those above are letters of other scripts.
_MAP = np.array([_symbol(c) for c in range(0x10000)], np.uint8)


def symbols(text: str | None) -> np.ndarray:
    """The text's symbols with a gap on either side."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    s = np.zeros(len(raw) + 2, np.uint8)
    s[1:-1] = _MAP[np.minimum(raw, 0xFFFF)]
    if len(raw) and raw.max() > 0xFFFF:
        high = raw > 0xFFFF
        s[1:-1][high] = _OTHERS + raw[high] % OTHER
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
    s = s[keep]
    return s if s[-1] == 0 else np.append(s, np.uint8(0))


def grams(s: np.ndarray, n: int) -> np.ndarray:
    if len(s) < n:
        return np.empty(0, np.int64)
    k = s[: len(s) - n + 1].astype(np.int64)
    for i in range(1, n):
        k = (k << _BITS) | s[i : len(s) - n + 1 + i]
    return k


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row may teach nothing: crc32 of doc_id as text is divisible by 5; true for a null doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        gram, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(gram), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(gram[at : at + (1 << 16)]), pa.array(n[at : at + (1 << 16)])], names=["gram", "n"])

    held, size = [], 0
    for batch in slices(batches):
        for text in batch.column(0):
            held.append(grams(symbols(text.as_py()), ORDER))
            size += len(held[-1])
            if size > CHUNK:
                yield from counted(held)
                held, size = [], 0
    if held:
        yield from counted(held)


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts, kinds = batch.column(0).to_pylist(), list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
        for kind in sorted(set(kinds)):
            u, n = np.unique(np.concatenate([grams(symbols(t), ORDER) for t, k in zip(texts, kinds, strict=True) if k == kind]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), x, np.int32)) for x in kind] + [pa.array(u), pa.array(n)], names=["toxic", "fold", "gram", "n"])


def discount(once: int, twice: int) -> float:
    """Absolute discount by the numbers of grams that are there once and twice."""
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def _known(counts: DataFrame, order: int, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(grams of the contexts given, their counts, the order's discount). What is collected has at most a row for each context and symbol."""
    few = counts.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    if order > 1:
        wanted = counts.sparkSession.createDataFrame(pa.table({"context": pa.array(contexts)}))
        counts = counts.join(F.broadcast(wanted), F.shiftright("gram", _BITS) == F.col("context"), "left_semi")
    rows = counts.select("gram", "n").toArrow()
    return rows["gram"].to_numpy(), rows["n"].to_numpy(), discount(*few)


def backed(contexts: np.ndarray, gram: np.ndarray, n: np.ndarray, d: float, lower: np.ndarray) -> np.ndarray:
    """P(symbol | context) by rows of contexts (ascending): discounted counts, and what is left by the lower order (rows of contexts, too)."""
    seen = np.zeros((len(contexts), _ALL))
    at = np.searchsorted(contexts, gram >> _BITS)
    at = np.minimum(at, max(0, len(contexts) - 1))
    own = contexts[at] == gram >> _BITS if len(contexts) else np.zeros(len(gram), bool)
    np.add.at(seen, (at[own], gram[own] & (_ALL - 1)), n[own])
    total, off = seen.sum(axis=1, keepdims=True), np.minimum(seen, d)
    spare = np.where(total > 0, off.sum(axis=1, keepdims=True) / np.maximum(total, 1), 1.0)
    return (seen - off) / np.maximum(total, 1) + spare * lower


def tail(gram: np.ndarray, n: int) -> np.ndarray:
    """The last n symbols of grams."""
    return gram & ((1 << _BITS * n) - 1)


def shared_model(counts: DataFrame, contexts: np.ndarray) -> np.ndarray:
    """P(symbol | context) by rows of contexts (of SHARED - 1 symbols, ascending) under the shared model. counts: gram, n of all grams of ORDER symbols."""
    tables, own = {ORDER: counts}, {SHARED: contexts}
    for order in range(ORDER - 1, 0, -1):
        tables[order] = stored(tables[order + 1].groupBy((F.col("gram").bitwiseAND((1 << _BITS * order) - 1)).alias("gram")).agg(F.count("*").alias("n")), "continuations")
    for order in range(SHARED - 1, 0, -1):
        own[order] = np.unique(tail(own[order + 1], order - 1))
    gram, n, _ = _known(tables[1], 1, own[1])
    single = np.full(_ALL, 0.5)
    np.add.at(single, gram, n)
    p = np.tile(single / single.sum(), (1, 1))
    for order in range(2, SHARED + 1):
        p = backed(own[order], *_known(tables[order], order, own[order]), p[np.searchsorted(own[order - 1], tail(own[order], order - 2))])
    return p


def class_model(gram: np.ndarray, toxic: np.ndarray, n: np.ndarray, shared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts of 4 symbols that either class has, ascending; symbols that some text has; for each context the log-likelihood ratio of each of these after it). shared: P(symbol | context) for contexts of SHARED - 1 symbols given."""
    context, used = np.unique(gram >> _BITS), np.unique(gram & (_ALL - 1))
    own = {ORDER: context}
    for order in range(ORDER - 1, SHARED - 1, -1):
        own[order] = np.unique(tail(own[order + 1], order - 1))
    base, ratio = shared(own[SHARED]), np.zeros((len(context), len(used)), np.float32)
    for c, sign in ((1, 1), (0, -1)):
        order = np.argsort(gram[toxic == c], kind="stable")
        tables = {ORDER: (gram[toxic == c][order], n[toxic == c][order])}
        for order in range(ORDER - 1, SHARED, -1):
            tables[order] = np.unique(tail(tables[order + 1][0], order), return_counts=True)
        p = base
        for order in range(SHARED + 1, ORDER):
            p = backed(own[order], *tables[order], CLASS_DISCOUNT, p[np.searchsorted(own[order - 1], tail(own[order], order - 2))])
        g, k = tables[ORDER]
        for at in range(0, len(context), 4096):
            some = context[at : at + 4096]
            first, last = np.searchsorted(g, [some[0] << _BITS, (some[-1] + 1) << _BITS])
            top = backed(some, g[first:last], k[first:last], CLASS_DISCOUNT, p[np.searchsorted(own[ORDER - 1], tail(some, ORDER - 2))])
            ratio[at : at + 4096] += (sign * np.log(top))[:, used]
    return context, used, ratio


_made: dict = {}


def _tables(model) -> tuple:
    """The broadcast model as small tables: number of each symbol (unknown: the last), row of the first 3 symbols, row of those and the fourth, ratios of the fifth (row 0: unknown). Made once a task: a worker that went on to another stage must not keep them."""
    key, context, used, ratio = model.value
    if _made.get("key") != key:
        base = len(used) + 1
        number = np.full(_ALL, len(used), np.int32)
        number[used] = np.arange(len(used))
        prefix, at = np.unique(context >> _BITS, return_inverse=True)
        first, second = np.zeros(base**3, np.int32), np.zeros((len(prefix) + 1, base), np.int32)
        first[(number[prefix >> 2 * _BITS] * base + number[(prefix >> _BITS) & (_ALL - 1)]) * base + number[prefix & (_ALL - 1)]] = 1 + np.arange(len(prefix))
        second[1 + at, number[context & (_ALL - 1)]] = 1 + np.arange(len(context))
        ratios = np.zeros((len(context) + 1, base), np.float32)
        ratios[1:, :-1] = ratio
        _made.update(key=key, tables=(number, base, first, second.ravel(), ratios.ravel()))
    return _made["tables"]


#: Columns of measures(): words above LEVELS, excess above EXCESS, highest window, mean, mean of the three best words, best word, words; then the square roots of the symbols' shares.
MEASURES = len(LEVELS) + len(EXCESS) + 5


def measures(text: str | None, number: np.ndarray, base: int, first: np.ndarray, second: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    out = np.zeros(MEASURES + _ALL)
    own = symbols(text)
    s = number[own]
    if len(s) < ORDER:
        return out
    n = len(s) - ORDER + 1
    k = (s[:n] * base + s[1 : n + 1]) * base + s[2 : n + 2]
    v = ratio[second[first[k] * base + s[3 : n + 3]] * base + s[4:]]
    run = np.concatenate([np.zeros(ORDER), np.cumsum(v, dtype=np.float64)])  # sum of what stands before each place
    gaps = np.flatnonzero(own == 0)
    words = run[gaps[1:] + 1] - run[gaps[:-1] + 1]
    w, best = min(WINDOW, n), np.sort(words)[::-1]
    at = [*((words > x).sum() for x in LEVELS), *(np.maximum(words - x, 0).sum() for x in EXCESS), (run[ORDER - 1 + w :] - run[ORDER - 1 : len(run) - w]).max() / WINDOW, run[-1] / n, best[:3].mean(), best[0], len(words)]
    out[:MEASURES] = at
    out[MEASURES:] = np.sqrt(np.bincount(own, minlength=_ALL) / max(1, (own > 0).sum()))
    out[MEASURES] = 0
    return out


def _measured(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = _tables(model)
            rows = [measures(t.as_py(), *own) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "toxic", "m"])
        _made.clear()

    return run


class Judge:
    """What a text's measures say: centres of clusters of symbol shares, what their ordinary texts have of each measure a word, and the logistic function's weights."""

    def __init__(self, m: np.ndarray, toxic: np.ndarray):
        shares, long = m[:, MEASURES:], m[:, MEASURES - 1] >= 10
        self.centres = _centres(shares[long] if long.any() else shares)
        cluster, counted = self.cluster(m), MEASURES - 5
        whole = (toxic == 0) | ~(toxic == 0).any()
        self.rates = np.zeros((len(self.centres), counted))
        for c in range(len(self.centres)):
            own = whole & (cluster == c) if (whole & (cluster == c)).sum() >= 5 else whole
            self.rates[c] = m[own, :counted].sum(axis=0) / max(1.0, m[own, MEASURES - 1].sum())
        self.w = logistic(self.features(m), toxic.astype(float), 1.0, np.where(toxic == 1, TOXIC_WEIGHT, 1.0))

    def cluster(self, m: np.ndarray) -> np.ndarray:
        shares = m[:, MEASURES:]
        return np.argmin((self.centres**2).sum(axis=1) - 2 * shares @ self.centres.T, axis=1)

    def features(self, m: np.ndarray) -> np.ndarray:
        usual = self.rates[self.cluster(m)] * m[:, MEASURES - 1 : MEASURES]
        over = (m[:, : MEASURES - 5] - usual) / np.sqrt(usual + 1)
        return np.hstack([np.sign(over) * np.log1p(np.abs(over)), m[:, MEASURES - 5 : MEASURES - 1]])

    def score(self, m: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(m) @ self.w[:-1] + self.w[-1], -700, 700)))


def _centres(x: np.ndarray, steps: int = 25) -> np.ndarray:
    """Centres of at most CLUSTERS groups of rows: each next one begins at the row furthest from all before, then means are taken in turns."""
    c = x[:1]
    while len(c) < min(CLUSTERS, len(x)):
        c = np.vstack([c, x[np.argmax(((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1))]])
    for _ in range(steps):
        own = np.argmin((c**2).sum(axis=1) - 2 * x @ c.T, axis=1)
        c = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
    return c


def _scored(model, judge: Judge):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = _tables(model)
            m = np.array([measures(t.as_py(), *own) for t in batch.column(1)]).reshape(-1, MEASURES + _ALL)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(judge.score(m))], names=["key", "score"])
        _made.clear()

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Weights of standardised features and the intercept by Newton steps, as weights of the raw features."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, keep, weight = np.zeros(z.shape[1]), ridge * np.eye(z.shape[1]), np.broadcast_to(weight, len(x))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + keep, z.T @ (weight * (y - p)) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] / scale * mean).sum())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(broadcast model, judge); None where the labels that may teach lack a class.

    Labels with a null doc_id or toxic are passed over; of several for one document the highest counts. The shared counts read every document.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    picks = [known.where(F.col("toxic") == t).orderBy(F.crc32(F.concat(F.lit("pick"), F.col("doc_id").cast("string"))), "doc_id").limit(sample) for t in (0, 1)]
    picked = [(r["doc_id"], r["toxic"]) for p in picks for r in p.collect()]  # at most 2 * sample rows
    if len({t for _, t in picked}) < 2:
        return None
    mine = spark.createDataFrame([(d, t, zlib.crc32(f"fit{d}".encode()) % FOLDS) for d, t in picked], "doc_id long, toxic int, fold int")
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(mine), "doc_id"), "labelled")
    own = texts.select("text", "toxic", "fold").mapInArrow(_class_counts, "toxic int, fold int, gram long, n long").groupBy("toxic", "fold", "gram").agg(F.sum("n").alias("n")).toArrow()  # of a bounded sample
    toxic, fold, gram, n = (own[c].to_numpy() for c in ("toxic", "fold", "gram", "n"))
    if not len(gram):
        return None
    counts = stored(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_shared_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    contexts = np.unique(tail(gram >> _BITS, SHARED - 1))
    table_ = shared_model(counts, contexts)

    def made(some: np.ndarray):
        keys, at = np.unique((toxic[some].astype(np.int64) << ORDER * _BITS) | gram[some], return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, n[some])
        model = class_model(keys & ((1 << ORDER * _BITS) - 1), keys >> ORDER * _BITS, sums, lambda c: table_[np.searchsorted(contexts, c)])
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, *model))
        del model, keys, at, sums
        give_back()
        return sent

    rows = []
    for f in range(FOLDS):
        if len(set(toxic[fold != f].tolist())) == 2:
            model = made(fold != f)
            rows.append(texts.where(F.col("fold") == f).select("doc_id", "toxic", "text").mapInArrow(_measured(model), "doc_id long, toxic int, m array<double>").toArrow())  # of a bounded sample
            model.destroy()  # all that it was for is here
    if not rows:
        return None
    every = pa.concat_tables(rows).sort_by([("doc_id", "ascending"), ("toxic", "ascending")]).combine_chunks()
    y, m = every["toxic"].to_numpy(), every["m"].combine_chunks().flatten().to_numpy().reshape(-1, MEASURES + _ALL)
    if len(set(y.tolist())) < 2:
        return None
    fitted = made(np.ones(len(gram), bool)), Judge(m, y)
    del own, toxic, fold, gram, n, table_, contexts, rows, every, m, made
    give_back()
    return fitted


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, score of every row of docs (doc_id, text; others are ignored): 0 to 1, from the text alone. Null texts count as empty; without labels of both classes every score is 0."""
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    if (fitted := fit(docs, labels, sample)) is None:
        return rows.select(F.col("key").alias("doc_id"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_scored(*fitted), "key long, score double").withColumnRenamed("key", "doc_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def _tag(model, judge: Judge, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = _tables(model)
            m = np.array([measures(t.as_py(), *own) for t in batch.column(at)]).reshape(-1, MEASURES + _ALL)
            yield batch.filter(pa.array(judge.score(m) < 0.5))
        _made.clear()

    return run


def ordinary_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose score is below 0.5, all columns as they are."""
    if (fitted := fit(docs, table(spark, sf_dir, "labels"))) is None:
        return docs
    return docs.mapInArrow(_tag(*fitted, docs.columns.index("text")), docs.schema)
