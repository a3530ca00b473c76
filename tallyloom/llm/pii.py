r"""Personal data: spans of four fixed kinds, and terms that reveal them, with DataFrame operations only.

The fixed kinds are found by patterns. What they find are protected entities; terms (words of three signs or more that begin with a letter) that stand near them may give them away even where the entity itself is masked. How strongly a term t discloses an entity c is estimated from all documents: pointwise mutual information over the entity's information, ln(N n(t, c) / (n(t) n(c))) / ln(N / n(c)), where n counts documents: with c, with t, and with t at most NEAR words from c. It is 1 if t is nowhere without c, and 0 if the two are independent. Terms that stand near an entity in at least SUPPORT different texts and whose disclosure reaches GENERALISED are spans of the kind term in each text that holds the entity, wherever they stand there; from REMOVED on they are taken out, below that replaced by their kind.

Offsets are code points, made without walking a text by signs: a pattern's matches and the gaps between them alternate, so the sum of their lengths in order is where each begins. Only matches move, by the text's md5, so copies of a text are one text; texts move to count nothing. Patterns are written so that a text of any length takes time in proportion: a run of signs is entered at its start (or where the last match ended), and repeats never step back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import among, once, scratch, sized, stored, table

KINDS = ("email", "ip", "card", "phone", "term")
#: The same matches, leftmost and not overlapping, as the plain patterns give:
#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) and [0-9]([\x20-]?[0-9])+ and \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A sign without which a kind has no match.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
TERM = r"\p{L}[\p{L}\p{N}]{2,}"
_PART = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"^0*{_PART}\.0*{_PART}\.0*{_PART}\.0*{_PART}$"
NEAR, SUPPORT, GENERALISED, REMOVED = 8, 2, 0.8, 0.95
#: Signs of text on either side of a match in which its NEAR words are looked for.
_SIDE = 160
_NONE = "array<struct<kind:int,i:int,gap:int,size:int,value:string,near:array<string>>>"


def luhn(digits: Column) -> Column:
    """Whether a text of up to 19 digits has the check digit of Luhn."""
    back = F.reverse(digits)
    one = lambda i: F.coalesce(F.try_to_number(F.substring(back, i, 1), F.lit("9")).cast("int"), F.lit(0))
    total = sum((one(i) if i % 2 else F.pmod(2 * one(i), F.lit(10)) + F.floor(2 * one(i) / 10) for i in range(1, 20)), F.lit(0))
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(_IP)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(F.substring(digits, 1, 19))
    return F.length(digits).between(8, 15) if kind == "phone" else F.lit(True)


def _entity(kind: str, match: Column) -> Column:
    """An entity's name: however it is written, it is the same."""
    plain = F.lower(match) if kind == "email" else match if kind == "ip" else F.regexp_replace(match, "[^0-9]", "")
    return F.concat(F.lit(f"{kind}:"), plain)


def _near(before: Column, after: Column) -> Column:
    """The terms at most NEAR words away in the gaps on either side. Words that touch the match or are cut off aren't whole."""
    head, tail = F.regexp_replace(F.right(before, F.lit(_SIDE)), r"[\p{L}\p{N}]+$", ""), F.regexp_replace(F.left(after, F.lit(_SIDE)), r"^[\p{L}\p{N}]+", "")
    head = F.when(F.length(before) > _SIDE, F.regexp_replace(head, r"^[\p{L}\p{N}]+", "")).otherwise(head)
    tail = F.when(F.length(after) > _SIDE, F.regexp_replace(tail, r"[\p{L}\p{N}]+$", "")).otherwise(tail)
    word = F.lit(r"[\p{L}\p{N}]+")
    last = F.slice(F.reverse(F.regexp_extract_all(head, word, F.lit(0))), 1, NEAR)
    first = F.slice(F.regexp_extract_all(tail, word, F.lit(0)), 1, NEAR)
    return F.array_distinct(F.transform(F.filter(F.concat(last, first), lambda w: w.rlike(f"^{TERM}$")), F.lower))


def matches(docs: DataFrame) -> DataFrame:
    """doc_id, key (md5 of the text), found of each row of docs: kind (number in KINDS), i (which of its kind's matches), gap (signs since the match before), size, value (the entity; null for a match that fails its check) and near (terms) of every match. Null texts count as empty; they have none."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    every = {}
    for kind, pattern in PATTERNS.items():
        got = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        every[kind] = F.when(F.contains("text", F.lit(_NEEDS[kind])), got) if kind in _NEEDS else got
    rows = once(rows, **every)
    some = lambda kind: F.coalesce(F.size(kind), F.lit(0)) > 0
    rows = once(rows, **{f"{kind}_gaps": F.when(some(kind), F.split("text", pattern, -1)) for kind, pattern in PATTERNS.items()})

    def of(number: int, kind: str) -> Column:
        def one(match: Column, i: Column) -> Column:
            good, gap = _valid(kind, match), F.get(f"{kind}_gaps", i)
            return F.struct(F.lit(number).alias("kind"), i.alias("i"), F.length(gap).alias("gap"), F.length(match).alias("size"), F.when(good, _entity(kind, match)).alias("value"), F.when(good, _near(gap, F.get(f"{kind}_gaps", i + 1))).alias("near"))

        return F.coalesce(F.transform(kind, one), F.array().cast(_NONE))

    found = F.concat(*(of(n, kind) for n, kind in enumerate(PATTERNS)))
    return rows.select("doc_id", F.md5("text").alias("key"), found.alias("found"))


def spans(found: DataFrame) -> DataFrame:
    """key, kind, start, end (exclusive), value, near of the matches that pass their checks, once for each different text. found: matches()."""
    each = found.where(F.size("found") > 0).select("key", F.explode("found").alias("f")).select("key", "f.kind", "f.i", "f.gap", "f.size", "f.value", "f.near")
    each = each.groupBy("key", "kind", "i").agg(*(F.first(c).alias(c) for c in ("gap", "size", "value", "near")))
    upto = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.col("size")).cast("long")).over(upto)
    return each.withColumn("end", end).where("value IS NOT NULL").select("key", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "value", "near")


def disclosures(docs: DataFrame, found: DataFrame, base: DataFrame) -> DataFrame:
    """term, value, disclosure of the pairs that reach GENERALISED. found, base: matches() and spans() of docs, written tables.

    Where a term stands near any entity is a bound for how many documents hold it at least; pairs that can't reach GENERALISED by it go first, so that only terms that are rare near entities are counted in the corpus. Of these counts a row a term moves.
    """
    copies = found.where(F.size("found") > 0).groupBy("key").agg(F.count("*").alias("n"))
    near = stored(base.select("value", "key", F.explode("near").alias("term")).groupBy("value", "term", "key").agg(F.lit(1).alias("_")).drop("_").join(copies, "key"), "near")
    pairs = near.groupBy("value", "term").agg(F.count("*").alias("texts"), F.sum("n").alias("both")).where(F.col("texts") >= SUPPORT)
    entities = base.groupBy("value", "key").agg(F.lit(1).alias("_")).join(copies, "key").groupBy("value").agg(F.sum("n").alias("entity"))
    around = near.groupBy("term", "key").agg(F.first("n").alias("n")).groupBy("term").agg(F.sum("n").alias("around"))
    every = F.lit(float(found.count()))
    most = F.col("both") * F.pow(every / F.col("entity"), F.lit(1 - GENERALISED)) * 1.001
    pairs = stored(pairs.join(entities, "value").join(around, "term").where(F.col("around") <= most).select("term", "value", "both", "entity"), "pairs")
    words = docs.select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.col("text").cast("string"), F.lit(TERM), F.lit(0)), F.lower))).alias("term"))
    terms = words.join(sized(pairs.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.count("*").alias("held"))
    d = F.try_divide(F.ln(every * F.col("both") / (F.col("held") * F.col("entity"))), F.ln(every / F.col("entity")))
    return stored(pairs.join(terms, "term").withColumn("disclosure", d).where(F.col("disclosure") >= GENERALISED).select("term", "value", "disclosure"), "told")


def revealing(docs: DataFrame, found: DataFrame, base: DataFrame) -> DataFrame:
    """key, start, end, disclosure of the terms that reveal an entity of the same text, but for those inside of base spans."""
    told = disclosures(docs, found, base)
    own = stored(base.select("key", "value").distinct().join(told.select("value").distinct(), "value", "left_semi"), "own")
    keys = own.select("key").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = among(docs.select(F.md5(text).alias("key"), text.alias("text")), keys, ["key"]).groupBy("key").agg(F.first("text").alias("text"))
    texts = once(texts, words=F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), gaps=F.split("text", TERM, -1))
    each = texts.select("key", F.posexplode(F.transform("words", lambda w, i: F.struct(F.lower(w).alias("term"), F.length(w).alias("size"), F.length(F.get("gaps", i)).alias("gap")))).alias("i", "w")).select("key", "i", "w.*")
    end = F.sum((F.col("gap") + F.col("size")).cast("long")).over(Window.partitionBy("key").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    each = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).join(told, "term").join(own, ["key", "value"], "left_semi").groupBy("key", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    both = each.unionByName(base.join(keys, "key", "left_semi").select("key", "start", "end", F.lit(None).cast("double").alias("disclosure")))
    order, fixed = Window.partitionBy("key").orderBy("start", F.col("disclosure").isNotNull()), F.col("disclosure").isNull()
    before = F.max(F.when(fixed, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(fixed, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = ~fixed & (F.coalesce(before, F.lit(0)) <= F.col("start")) & (after.isNull() | (after >= F.col("end")))
    return both.withColumn("_free", free).where("_free").drop("_free")


def _all(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matches(), written; key, kind, start, end, disclosure of all spans)."""
    found = stored(matches(docs), "found", keep=True)
    base = stored(spans(found), "spans", keep=True)
    terms = stored(revealing(docs, found, base), "terms", keep=True)
    return found, base.select("key", "kind", "start", "end", F.lit(None).cast("double").alias("disclosure")).unionByName(terms.select("key", F.lit(len(KINDS) - 1).alias("kind"), "start", "end", "disclosure"))


def listed(spans_: Column) -> Column:
    """kind:start:end of spans (array of struct kind, start, end, in order), comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of each row of docs (doc_id, text; others are ignored).

    Null and empty texts have no spans; repeated rows stay; an empty table gives no rows. The texts are read three times: for matches, for the words that are candidates, and those that hold a revealing term once more.
    """
    with scratch(docs.sparkSession):
        found, every = _all(docs)
    last = len(KINDS) - 1
    own = every.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("s"))
    fixed = F.filter("s", lambda x: x["kind"] < last)
    count = lambda k: F.size(F.filter("s", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    counts = [count(k) for k in range(last)]
    own = own.select("key", *counts, F.sha2(listed(fixed), 256).alias("base_sha256"), listed(F.col("s")).alias("spans"))
    none = [*(F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS[:last]), F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans")]
    some = F.size("found") > 0
    columns = [f"n_{k}" for k in KINDS[:last]]
    held = found.where(some).select("doc_id", "key").join(own, "key", "left")
    held = held.select("doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in columns), F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
    return held.unionByName(found.where(~some).select("doc_id", *none))


def sanitised(docs: DataFrame) -> DataFrame:
    """docs with sanitised text: spans of the fixed kinds and generalised terms are replaced by their kind in brackets, terms from REMOVED on are removed. Of spans that overlap the first (of equals the longest) is replaced up to where the furthest ends. Other columns stay; texts without spans are as they were."""
    with scratch(docs.sparkSession):
        _, every = _all(docs)
    order = Window.partitionBy("key").orderBy("start", F.desc("end"), "kind")
    run = every.withColumn("_new", (F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)) <= F.col("start")).cast("int"))
    run = run.withColumn("_g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    put = F.when(F.coalesce(F.col("disclosure") >= REMOVED, F.lit(False)), "").otherwise(F.concat(F.lit("["), F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1), F.lit("]")))
    whole = run.groupBy("key", "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by(put, F.struct("start", -F.col("end"), "kind")).alias("put"))
    own = whole.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "put"))).alias("_s"))
    rows = docs.select(F.md5(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("key"), F.struct(*(docs[c] for c in docs.columns)).alias("row")).join(own, "key", "left")
    text = F.col("row.text").cast("string")
    before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get("_s", i - 1)["end"])
    pieces = F.transform("_s", lambda s, i: F.concat(F.substring(text, (before(i) + 1).cast("int"), (s["start"] - before(i)).cast("int")), s["put"]))
    rest = F.substring(text, (F.element_at("_s", -1)["end"] + 1).cast("int"), F.length(text))
    changed = F.when(F.col("_s").isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return rows.select(*(changed.alias(c) if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document."""
    return scanned(table(spark, sf_dir, "documents"))
