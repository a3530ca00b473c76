"""Queries over the given tables, one or more for each operator, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import annotation, features, keys, nulls, text_rules
from tallyloom.operators import adapters, balance, folds, gates, intervals, ranges, resume, variants
from tallyloom.operators.contained import contained
from tallyloom.plans import curation, stages
from tallyloom.session import shared_dir
from tallyloom.sources import sinks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f"q_{f.__name__}"], SQL[f"q_{f.__name__}"] = f, sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})")


HASH = "list_reduce(list_transform(range(1, 65), lambda i: instr('0123456789abcdef', substr(sha256({k}), i, 1)) - 1), lambda a, d: (a * 16 + d) % {n}, 0)"


@query("SELECT doc_id, regexp_replace(replace(source || ':' || doc_id, ':', '__'), '[^A-Za-z0-9_-]+', '_', 'g') AS sample_id FROM documents")
def sample_id(spark, d):
    return t(spark, d, "documents").select("doc_id", keys.sample_id(F.concat_ws(":", "source", "doc_id")).alias("sample_id"))


@query("SELECT o_orderkey, o_custkey, coalesce(c_name, '') AS c_name, coalesce(c_mktsegment, '') AS segment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def left_enrich(spark, d):
    customers = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    out = resume.enriched(t(spark, d, "orders").select("o_orderkey", "o_custkey"), customers, ["o_custkey"])
    return out.select("o_orderkey", "o_custkey", F.coalesce("c_name", F.lit("")).alias("c_name"), F.coalesce("c_mktsegment", F.lit("")).alias("segment"))


def gated(spark, d) -> DataFrame:
    rows = t(spark, d, "documents").select("doc_id", "source", "lang", "n_chars", "text").join(t(spark, d, "labels"), "doc_id", "left")
    reason = gates.first_failure([
        (F.col("quality").isNull(), "not_labelled"),
        (~nulls.is_in(F.col("lang"), "en", "de", "fr"), "language"),
        (~F.col("n_chars").between(100, 20000), "length_out_of_range"),
        (F.col("toxic") == 1, "toxic"),
        (F.col("quality") == 0, "low_quality"),
    ])
    return rows.withColumn("reject_reason", reason).withColumn("flagged", F.contains("text", F.lit("license")))


GATED = """SELECT d.doc_id, d.source, d.text, CASE WHEN quality IS NULL THEN 'not_labelled' WHEN NOT coalesce(lang IN ('en', 'de', 'fr'), false) THEN 'language' WHEN NOT n_chars BETWEEN 100 AND 20000 THEN 'length_out_of_range'
  WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'low_quality' END AS reject_reason, contains(text, 'license') AS flagged FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@query(f"SELECT doc_id, reject_reason, flagged FROM ({GATED})")
def gate_chain(spark, d):
    return gated(spark, d).select("doc_id", "reject_reason", "flagged")


@query(f"SELECT count(*) AS n_records, count(*) FILTER (reject_reason IS NULL) AS n_accepted, count(*) FILTER (reject_reason IS NOT NULL) AS n_rejected, count(*) FILTER (flagged) AS n_flagged, false AS deduplication_performed FROM ({GATED})")
def gate_report(spark, d):
    bad = F.col("reject_reason").isNotNull()
    return gates.report(gated(spark, d), "n_records", ("n_accepted", ~bad), ("n_rejected", bad), ("n_flagged", F.col("flagged"))).withColumn("deduplication_performed", F.lit(False))


@query("SELECT doc_id, CASE WHEN n_chars > 0 THEN round(least(1.0, coalesce(list_sum(list_transform(regexp_extract_all(text, '([0-9]{1,9})', 1), lambda x: CAST(x AS DOUBLE))), 0.0) / n_chars), 6) END AS ratio FROM documents")
def regex_sum_ratio(spark, d):
    return t(spark, d, "documents").select("doc_id", F.round(features.silence_ratio(F.col("text"), "([0-9]{1,9})", F.col("n_chars")), 6).alias("ratio"))


@query("SELECT coalesce(CAST(quality AS VARCHAR), '') AS quality, count(*) AS n_rows FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1")
def status_counts(spark, d):
    rows = t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels"), "doc_id", "left").select(F.col("quality").cast("string").alias("quality"))
    return gates.counted(rows, "quality")


@query("""SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(*) FROM labels) AS n_labelled, (SELECT count(*) FROM labels WHERE toxic = 1) AS n_toxic, (SELECT count(*) FROM pages) AS n_pages,
  (SELECT count(*) FROM conversations) AS n_turns, (SELECT string_agg(lang || '=' || n, ',' ORDER BY lang) FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)) AS by_language""")
def pipeline_status(spark, d):
    # one row a relation, met on a constant key: each side is a global aggregate
    docs = t(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n")).agg(F.sum("n").alias("n_documents"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lang", "n"))), lambda x: F.concat(x["lang"], F.lit("="), x["n"].cast("string"))), ",").alias("by_language"))
    labels = t(spark, d, "labels").agg(F.count("*").alias("n_labelled"), F.count_if(F.col("toxic") == 1).alias("n_toxic"))
    sides = [docs, labels, t(spark, d, "pages").agg(F.count("*").alias("n_pages")), t(spark, d, "conversations").agg(F.count("*").alias("n_turns"))]
    out = sides[0].withColumn("one", F.lit(1))
    for s in sides[1:]:
        out = out.join(s.withColumn("one", F.lit(1)), "one")
    return out.drop("one")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_anti(spark, d):
    return resume.pending(t(spark, d, "documents").select("doc_id", "source"), t(spark, d, "labels").where("quality = 1"), ["doc_id"])


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_completed(spark, d):
    return t(spark, d, "documents").select("doc_id", "source").join(t(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")


UPDATES = "SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_acctbal < 0 UNION ALL SELECT -c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 9000"


@query(f"WITH u AS ({UPDATES}) SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal FROM (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM u) UNION ALL SELECT * FROM u)")
def upsert(spark, d):
    old = t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = old.where("c_acctbal < 0").withColumn("c_acctbal", F.col("c_acctbal") + 100).unionByName(old.where("c_acctbal > 9000").withColumn("c_custkey", -F.col("c_custkey")))
    return resume.upsert(old, new, ["c_custkey"]).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1")
def latest_wins(spark, d):
    order = (F.col(c) for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return resume.latest(t(spark, d, "lineitem"), ["l_orderkey"], *order).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("SELECT d.doc_id, d.source, CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.quality = 1 THEN 'checked' END ELSE d.lang END AS lang, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def row_merge(spark, d):
    right = t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "checked").alias("lang"), "toxic")
    return resume.merged(t(spark, d, "documents").select("doc_id", "source", "lang"), right, ["doc_id"], "left")


@query("SELECT o_orderkey, CASE WHEN l.l_orderkey IS NULL THEN 'missing' ELSE 'complete' END AS status, coalesce(l.n, 0) AS n_items FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey")
def inner_with_missing(spark, d):
    items = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    out = resume.enriched(t(spark, d, "orders").select("o_orderkey"), items, ["o_orderkey"])
    return out.select("o_orderkey", F.when(F.col("n").isNull(), "missing").otherwise("complete").alias("status"), F.coalesce("n", F.lit(0)).alias("n_items"))


@query("""SELECT doc_id, error FROM (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'annotation_missing' WHEN v.vec_id IS NULL THEN 'features_missing' END AS error
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN embeddings v ON d.doc_id = v.vec_id) WHERE error IS NOT NULL""")
def preflight_missing(spark, d):
    docs = t(spark, d, "documents").select("doc_id")
    labels = t(spark, d, "labels").select("doc_id", F.lit(True).alias("annotated"))
    vectors = t(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(True).alias("featured"))
    rows = docs.join(labels, "doc_id", "left").join(vectors, "doc_id", "left")
    return rows.select("doc_id", gates.first_failure([(F.col("annotated").isNull(), "annotation_missing"), (F.col("featured").isNull(), "features_missing")]).alias("error")).where("error IS NOT NULL")


def cascade_rows(spark, d) -> DataFrame:
    docs = t(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    full = t(spark, d, "labels").select("doc_id", F.col("quality").alias("full_check"))
    clean = t(spark, d, "labels").select("doc_id", F.col("toxic").alias("clean_check")).where("doc_id % 2 = 0")
    section = t(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("section"))
    rows = docs.join(full, "doc_id", "left").join(clean, "doc_id", "left").join(section, "doc_id", "left")
    lyric, accepted = F.col("lang") != "en", nulls.truthy(F.col("section") < 5)
    arms = [
        (F.col("lang") == "en", "original"),
        (lyric & nulls.truthy(F.col("full_check") == 1), "separated_full"),
        (lyric & nulls.truthy(F.col("clean_check") == 0), "separated_clean"),
        (lyric & accepted, "clean_section"),
        (lyric & nulls.truthy(F.col("clean_check") == 1) & ~accepted, "rejected"),
    ]
    out = gates.routed(rows, arms, "pending", "audio_source")
    waiting = F.when(F.col("audio_source") == "pending", F.when(F.col("full_check").isNotNull(), "needs_clean_separation").otherwise("vocal_check_incomplete"))
    return out.withColumn("pending_reason", waiting)


CASCADE = """SELECT doc_id, source, audio_source, CASE WHEN audio_source = 'pending' THEN CASE WHEN full_check IS NOT NULL THEN 'needs_clean_separation' ELSE 'vocal_check_incomplete' END END AS pending_reason FROM (
  SELECT d.doc_id, d.source, f.quality AS full_check, CASE WHEN lang = 'en' THEN 'original' WHEN coalesce(f.quality = 1, false) THEN 'separated_full' WHEN coalesce(c.toxic = 0, false) THEN 'separated_clean'
    WHEN coalesce(s.label < 5, false) THEN 'clean_section' WHEN coalesce(c.toxic = 1, false) THEN 'rejected' ELSE 'pending' END AS audio_source
  FROM documents d LEFT JOIN labels f ON d.doc_id = f.doc_id LEFT JOIN (SELECT * FROM labels WHERE doc_id % 2 = 0) c ON d.doc_id = c.doc_id LEFT JOIN embeddings s ON d.doc_id = s.vec_id)"""


@query(f"SELECT doc_id, audio_source, pending_reason FROM ({CASCADE})")
def cascade(spark, d):
    return cascade_rows(spark, d).select("doc_id", "audio_source", "pending_reason")


@query(f"SELECT audio_source, count(*) AS n_rows, count(DISTINCT source) AS n_sources FROM ({CASCADE}) GROUP BY 1")
def route_counts(spark, d):
    return cascade_rows(spark, d).groupBy("audio_source").agg(F.count("*").alias("n_rows"), F.countDistinct("source").alias("n_sources"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 25")
def limit_after_filter(spark, d):
    return resume.first_n(t(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), 25, "o_orderkey")


@query("SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS source_rank FROM documents")
def sorted_rank(spark, d):
    return intervals.ranked(t(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], ["n_chars", "doc_id"], "source_rank").select("source", "doc_id", "source_rank")


@query(f"SELECT doc_id, CAST({HASH.format(k='CAST(doc_id AS VARCHAR)', n=7)} AS BIGINT) AS part FROM documents")
def hash_partition(spark, d):
    return t(spark, d, "documents").select("doc_id", keys.hash_bucket(F.col("doc_id").cast("string"), 7).alias("part"))


@query("""WITH g AS (SELECT sha256(text) AS g, count(*) AS n FROM documents GROUP BY 1), o AS (SELECT g, coalesce(sum(n) OVER (ORDER BY sha256('42|' || g), g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
  SELECT doc_id, CASE WHEN before < (SELECT round_even(count(*) * 0.15, 0) FROM documents) THEN 'validation' ELSE 'train' END AS split FROM documents JOIN o ON sha256(text) = g""")
def group_split(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("shared"))
    return folds.group_split(docs, "shared", 0.15).select("doc_id", "split")


@query("SELECT count(*) - count(DISTINCT md5(text)) AS shared_excess, count(*) AS n_records FROM documents")
def shared_excess(spark, d):
    # sums per key first: no distinct over all texts in one task
    per = t(spark, d, "documents").groupBy(F.md5("text").alias("k")).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("shared_excess"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"))


@query("""WITH RECURSIVE r AS (SELECT p_brand, p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS w, row_number() OVER (PARTITION BY p_brand ORDER BY round(p_retailprice * 100) DESC, p_partkey) AS i FROM part),
  f AS (SELECT p_brand, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS b, CAST(NULL AS BIGINT) AS p_partkey, 0 AS part UNION ALL
    SELECT r.p_brand, r.i, f.a + CASE WHEN f.a <= f.b THEN r.w ELSE 0 END, f.b + CASE WHEN f.a <= f.b THEN 0 ELSE r.w END, r.p_partkey, CASE WHEN f.a <= f.b THEN 0 ELSE 1 END FROM f JOIN r ON r.p_brand = f.p_brand AND r.i = f.i + 1)
  SELECT DISTINCT p_brand, p_partkey, part FROM f WHERE p_partkey IS NOT NULL""".replace("f AS (SELECT p_brand, CAST(0", "f AS (SELECT DISTINCT p_brand, CAST(0").replace("0 AS part UNION ALL", "0 AS part FROM part UNION ALL"))
def balance_parts(spark, d):
    cents = t(spark, d, "part").select("p_brand", "p_partkey", F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"))
    return folds.balanced(cents, ["p_brand"], "cents", "p_partkey").select("p_brand", "p_partkey", "part")


@query(SQL["q_balance_parts"].replace("p_brand", "one").replace("SELECT one, p_partkey, CAST(round", "SELECT 0 AS one, p_partkey, CAST(round").replace("SELECT DISTINCT one, CAST(0", "SELECT DISTINCT 0 AS one, CAST(0").replace("OVER (PARTITION BY one ORDER", "OVER (ORDER").replace("SELECT DISTINCT one, p_partkey, part FROM f", "SELECT DISTINCT p_partkey, part FROM f"))
def balance_blocks(spark, d):
    # all parts are one group: blocks of it are balanced side by side
    cents = t(spark, d, "part").select("p_partkey", F.lit(0).alias("one"), "p_retailprice")
    return balance.balanced(cents, ["one"], "p_retailprice", "p_partkey", 0.01).select("p_partkey", "part")


def spans(spark, d) -> DataFrame:
    return t(spark, d, "events").select("user_id", "event_type", micros("ts").alias("start"), (micros("ts") + F.round(F.col("value") * 600).cast("bigint") * 1000000).alias("end"))


SPANS = "SELECT user_id, event_type, epoch_us(ts) AS start, epoch_us(ts) + CAST(round(value * 600) AS BIGINT) * 1000000 AS \"end\" FROM events"


def merged_sql(source: str, where: str = "true") -> str:
    return f"""SELECT user_id, min(start) AS start, max("end") AS "end", count(*) AS n_merged FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY user_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM ({source}) WHERE {where})) GROUP BY user_id, island"""


@query(merged_sql(SPANS))
def interval_merge(spark, d):
    return intervals.merged_intervals(spans(spark, d).drop("event_type"), ["user_id"])


#: Microseconds of a bucket of a scan over one key.
WEEK = 7 * 86_400_000_000
HOUR = 3_600_000_000


@query(merged_sql(SPANS).replace("user_id", "one").replace("SELECT one, event_type", "SELECT 0 AS one, event_type"))
def merge_scan(spark, d):
    # all spans are one key's: merged bucket by bucket
    return intervals.merged_intervals(spans(spark, d).select(F.lit(0).alias("one"), "start", "end"), ["one"], width=WEEK)


CLEAN = f"""WITH k AS ({merged_sql(SPANS, "event_type <> 'error'")}), c AS ({merged_sql(SPANS, "event_type = 'error'")}),
  m AS (SELECT user_id, edge, sum(k) AS k, sum(c) AS c FROM (SELECT user_id, start AS edge, 1 AS k, 0 AS c FROM k UNION ALL SELECT user_id, "end", -1, 0 FROM k UNION ALL SELECT user_id, start, 0, 1 FROM c UNION ALL SELECT user_id, "end", 0, -1 FROM c) GROUP BY 1, 2),
  s AS (SELECT user_id, edge AS start, lead(edge) OVER (PARTITION BY user_id ORDER BY edge) AS "end", sum(k) OVER w > 0 AND sum(c) OVER w = 0 AS inside FROM m WINDOW w AS (PARTITION BY user_id ORDER BY edge ROWS UNBOUNDED PRECEDING)),
  p AS (SELECT user_id, start, "end" FROM ({merged_sql('SELECT * FROM s WHERE inside AND "end" IS NOT NULL')}))"""


def clean_spans(spark, d) -> DataFrame:
    rows = spans(spark, d)
    return intervals.subtracted(rows.where("event_type <> 'error'").drop("event_type"), rows.where("event_type = 'error'").drop("event_type"), ["user_id"])


@query(f'{CLEAN} SELECT user_id, start, "end" FROM p')
def interval_subtract(spark, d):
    return clean_spans(spark, d)


@query(f'{CLEAN} SELECT user_id, start, "end" FROM p')
def subtract_scan(spark, d):
    rows = spans(spark, d)
    return intervals.subtracted(rows.where("event_type <> 'error'").drop("event_type"), rows.where("event_type = 'error'").drop("event_type"), ["user_id"], width=WEEK)


@query(f'{CLEAN} SELECT user_id, start, "end" FROM p WHERE "end" - start >= 3600000000 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "end" - start DESC, start) = 1')
def longest_clean_run(spark, d):
    return intervals.longest(clean_spans(spark, d).where(F.col("end") - F.col("start") >= 3600000000), ["user_id"])


@query("SELECT doc_id, CAST(i AS BIGINT) AS chunk_index, CAST(i * 250 AS BIGINT) AS chunk_start, least(n_chars, CAST(i * 250 + 300 AS BIGINT)) AS chunk_end FROM (SELECT doc_id, n_chars, unnest(range(CAST(greatest(0, ceil((n_chars - 100) / 250.0)) AS BIGINT))) AS i FROM documents)")
def chunking(spark, d):
    out = intervals.chunked(t(spark, d, "documents").select("doc_id", "n_chars"), "n_chars", 250, 300, 100)
    return out.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("chunk_start").cast("long").alias("chunk_start"), F.col("chunk_end").cast("long").alias("chunk_end"))


@query("""SELECT a.event_id, coalesce(min(b.at), any_value(a.at)) AS snapped FROM (SELECT event_id, user_id, epoch_us(ts) AS at FROM events WHERE event_type = 'purchase') a
  LEFT JOIN (SELECT user_id, epoch_us(ts) AS at FROM events WHERE event_type = 'view') b ON a.user_id = b.user_id AND b.at BETWEEN a.at AND a.at + 86400000000 GROUP BY a.event_id""")
def snap_nearest(spark, d):
    rows = t(spark, d, "events").where("event_type IN ('purchase', 'view')").select("event_id", "user_id", "event_type", micros("ts").alias("at"))
    found = intervals.next_within(rows, ["user_id"], "at", F.col("event_type") == "view", 86400000000, "next")
    return found.where("event_type = 'purchase'").select("event_id", F.coalesce("next", "at").alias("snapped"))


@query("""WITH a AS (SELECT event_id, event_type, epoch_us(ts) AS us FROM events) SELECT event_id, v AS next FROM (SELECT event_id, us, min(CASE WHEN event_type = 'view' THEN us END) OVER (ORDER BY us RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM a) WHERE v - us <= 3600000000""")
def next_scan(spark, d):
    # the next view by anybody within an hour: one key for all events
    rows = t(spark, d, "events").select("event_id", F.lit(0).alias("one"), "event_type", micros("ts").alias("at"))
    return intervals.next_within(rows, ["one"], "at", F.col("event_type") == "view", HOUR, "next", width=HOUR).where("next IS NOT NULL").select("event_id", "next")


@query(f"""WITH s AS ({SPANS.replace("SELECT user_id", "SELECT event_id, user_id")}) SELECT a.event_id AS purchase, b.event_id AS error, least(a."end", b."end") - greatest(a.start, b.start) AS shared
  FROM s a JOIN s b ON a.user_id = b.user_id AND a.start < b."end" AND b.start < a."end" WHERE a.event_type = 'purchase' AND b.event_type = 'error'""")
def range_join(spark, d):
    rows = t(spark, d, "events").select("event_id", "user_id", "event_type", micros("ts").alias("start"), (micros("ts") + F.round(F.col("value") * 600).cast("bigint") * 1000000).alias("end"))
    side = lambda kind: rows.where(F.col("event_type") == kind).drop("event_type")
    out = ranges.overlapping(side("purchase"), side("error"), ["user_id"])
    return out.select(F.col("left_event_id").alias("purchase"), F.col("right_event_id").alias("error"), (F.least("left_end", "right_end") - F.greatest("left_start", "right_start")).alias("shared"))


def turns(spark, d) -> DataFrame:
    """Turns of a conversation as sections one after the other, each as long as its text."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    rows = t(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"))
    return rows.withColumn("end", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("n"))


TURNS = 'SELECT conv_id, turn, role, CAST(sum(length(text)) OVER w - length(text) AS BIGINT) AS start, CAST(sum(length(text)) OVER w AS BIGINT) AS "end" FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)'


@query(f"""SELECT conv_id, CAST(sum(greatest(0, least("end", 1000) - greatest(start, 200)) * CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 2 ELSE 1 END) AS BIGINT) AS score FROM ({TURNS}) GROUP BY 1""")
def overlap_weight(spark, d):
    weight = features.lookup({"user": 4, "assistant": 2}, F.col("role"), 1)
    part = intervals.overlap(F.lit(200), F.lit(1000), F.col("start"), F.col("end")) * weight
    return turns(spark, d).groupBy("conv_id").agg(F.sum(part).cast("long").alias("score"))


@query(f"""WITH s AS ({TURNS}), d AS (SELECT conv_id, max("end") AS n FROM s GROUP BY 1), a AS (SELECT DISTINCT conv_id, CAST(start AS DOUBLE) AS s FROM s UNION SELECT conv_id, CAST(n AS DOUBLE) FROM d),
  w AS (SELECT x.conv_id, x.s, max(y.s) AS e FROM a x JOIN a y ON x.conv_id = y.conv_id AND y.s - x.s BETWEEN 60 AND 600 + 1e-6 GROUP BY 1, 2),
  c AS (SELECT w.conv_id, w.s, w.e, sum(greatest(0, least(w.e, s."end") - greatest(w.s, s.start)) * CASE role WHEN 'user' THEN 4.0 WHEN 'assistant' THEN 2.0 ELSE 1.0 END) AS score FROM w JOIN s ON s.conv_id = w.conv_id GROUP BY 1, 2, 3)
  SELECT d.conv_id, CASE WHEN n <= 600 THEN 0.0 ELSE b.s END AS "start", CASE WHEN n <= 600 THEN CAST(n AS DOUBLE) ELSE b.e END AS "end", n > 600 AND b.s IS NOT NULL AS trimmed
  FROM d LEFT JOIN (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, e - s DESC, s) = 1) b ON d.conv_id = b.conv_id""")
def best_window(spark, d):
    section = F.struct(F.col("role").alias("label"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))
    convs = turns(spark, d).groupBy("conv_id").agg(F.max("end").cast("double").alias("n"), F.array_sort(F.collect_list(section)).alias("sections"))
    best = intervals.best_window(F.col("n"), F.col("sections.start"), F.col("sections"), lambda label: features.lookup({"user": 4.0, "assistant": 2.0}, label, 1.0), 600.0)
    return convs.select("conv_id", best.alias("b"), "n").select("conv_id", "b.start", "b.end", ((F.col("n") > 600) & F.col("b.start").isNotNull()).alias("trimmed"))


@query("SELECT user_id, count(*) AS n_runs, string_agg(event_type, '>' ORDER BY ts) AS runs FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events WHERE event_type <> 'error') WHERE event_type IS DISTINCT FROM prev GROUP BY 1")
def collapse_runs(spark, d):
    listed = t(spark, d, "events").where("event_type <> 'error'").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_type"))).alias("e"))
    runs = features.collapse(F.col("e.event_type"))
    return listed.select("user_id", F.size(runs).cast("long").alias("n_runs"), F.array_join(runs, ">").alias("runs"))


@query("SELECT conv_id, string_agg('[' || role || ']' || chr(10) || '[Instrumental]', chr(10) || chr(10) ORDER BY turn) || chr(10) AS lyrics FROM conversations GROUP BY 1")
def lyrics_template(spark, d):
    listed = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("s"))
    return listed.select("conv_id", features.lyrics(F.col("s.role")).alias("lyrics"))


@query("""WITH e AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'click' THEN 'Drop' WHEN 'signup' THEN 'Intro' WHEN 'error' THEN 'Break' ELSE 'Theme' END AS label FROM events)
  SELECT event_id, CASE WHEN label = 'Drop' AND count(*) FILTER (label = 'Drop') OVER u >= 2 AND ts = max(ts) FILTER (label = 'Drop') OVER u THEN 'Final Drop' ELSE label END AS label FROM e WINDOW u AS (PARTITION BY user_id)""")
def section_map(spark, d):
    raw = features.lookup({"click": "chorus", "signup": "intro", "error": "bridge"}, F.col("event_type"), "verse")
    listed = t(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", raw.alias("raw")))).alias("e"))
    labels = F.arrays_zip(F.col("e.event_id").alias("event_id"), features.section_labels(F.col("e.raw")).alias("label"))
    return listed.select(F.explode(labels).alias("x")).select(F.col("x.event_id").alias("event_id"), F.col("x.label").alias("label"))


@query("SELECT c_custkey, CASE WHEN trunc(c_acctbal) BETWEEN 40 AND 2500 THEN CAST(trunc(c_acctbal) AS INTEGER) END AS bpm FROM customer")
def range_null(spark, d):
    return t(spark, d, "customer").select("c_custkey", features.int_in_range(F.col("c_acctbal"), 40, 2500).alias("bpm"))


@query("SELECT user_id, CASE WHEN count(*) >= 16 AND count(*) FILTER (event_type = 'view') >= 4 AND count(*) FILTER (p BETWEEN 1 AND 4) >= 0.9 * count(*) AND max(p) = 4 THEN '4' END AS timesignature, min(p) AS least, max(p) AS most FROM (SELECT user_id, event_type, CAST(event_id % 4 + 1 AS INTEGER) AS p FROM events) GROUP BY 1")
def array_rule(spark, d):
    position = (F.col("event_id") % 4 + 1).cast("int")
    listed = t(spark, d, "events").groupBy("user_id").agg(F.collect_list(position).alias("p"), F.collect_list(F.when(F.col("event_type") == "view", F.col("event_id"))).alias("down"))
    return listed.select("user_id", features.time_signature(F.col("p"), F.col("down")).alias("timesignature"), F.array_min("p").alias("least"), F.array_max("p").alias("most"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}\p{M}_''-]+')) AS INTEGER) AS n_words FROM documents")
def word_count(spark, d):
    return t(spark, d, "documents").select("doc_id", text_rules.word_count(F.col("text")).alias("n_words"))


@query(r"""SELECT doc_id, list_aggregate(list_sort(list_distinct(list_filter([CASE WHEN n NOT BETWEEN 40 AND 80 THEN 'caption_word_count:' || n END, CASE WHEN contains(low, 'license') OR contains(low, 'rights reserved') THEN 'banned_phrase' END,
  CASE WHEN regexp_matches(low, '[0-9]{2,3}\s*bpm') THEN 'bpm_leaked' END, CASE WHEN NOT starts_with(low, 'the') THEN 'caption_start' END, CASE WHEN lang NOT IN ('en', 'de') THEN 'invalid_language' END], lambda x: x IS NOT NULL))), 'string_agg', ',') AS errors
  FROM (SELECT doc_id, lang, lower(text) AS low, len(regexp_extract_all(text, '[\p{L}\p{N}\p{M}_''-]+')) AS n FROM documents)""")
def caption_rules(spark, d):
    text, low, n = F.col("text"), F.lower("text"), F.col("n")
    errors = text_rules.error_codes(
        (~n.between(40, 80), F.concat(F.lit("caption_word_count:"), n.cast("string"))),
        (text_rules.has_phrase(text, ["license", "rights reserved"]), "banned_phrase"),
        (low.rlike(r"[0-9]{2,3}\s*bpm"), "bpm_leaked"),
        (~low.startswith("the"), "caption_start"),
        (~F.col("lang").isin("en", "de"), "invalid_language"),
    )
    rows = t(spark, d, "documents").select("doc_id", "text", "lang", text_rules.word_count(text).alias("n"))
    return rows.select("doc_id", errors.alias("e")).select("doc_id", F.when(F.size("e") > 0, F.array_join("e", ",")).alias("errors"))


@query(r"""SELECT p_partkey, array_to_string(list_transform(list_filter(regexp_split_to_array(p_name || ' feat. ' || p_type || ' & ' || p_brand, '(?i)\b(?:feat\.?|ft\.?|and)\b|[&,/+|]'), lambda v: length(trim(v)) >= 4), lambda v: lower(trim(regexp_replace(v, '\s+', ' ', 'g')))), ';') AS names FROM part""")
def name_split(spark, d):
    value = F.concat("p_name", F.lit(" feat. "), "p_type", F.lit(" & "), "p_brand")
    return t(spark, d, "part").select("p_partkey", F.array_join(text_rules.names(value), ";").alias("names"))


@query("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))")
def contamination(spark, d):
    return contained(t(spark, d, "documents"), t(spark, d, "benchmark"), "doc_id", "item_id")


@query("SELECT user_id, list_has_any(list(DISTINCT event_type), ['error', 'signup']) AS outside, CAST(count(DISTINCT event_type) AS INTEGER) AS n_types FROM events GROUP BY 1")
def domain_check(spark, d):
    listed = t(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("e"))
    return listed.select("user_id", text_rules.outside(F.col("e"), ["click", "view", "purchase"]).alias("outside"), F.size("e").alias("n_types"))


@query("SELECT doc_id, CASE WHEN toxic = 1 AND quality = 1 THEN 'inconsistent_action' WHEN toxic = 1 THEN 'drop' WHEN quality = 1 THEN 'keep' ELSE 'review' END AS action FROM labels")
def consistency_check(spark, d):
    arms = [((F.col("toxic") == 1) & (F.col("quality") == 1), "inconsistent_action"), (F.col("toxic") == 1, "drop"), (F.col("quality") == 1, "keep")]
    return gates.routed(t(spark, d, "labels"), arms, "review", "action").select("doc_id", "action")


@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'invalid_json' ELSE 'ok' END AS status, CASE WHEN event_id % 10 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events")
def json_permissive(spark, d):
    broken = F.col("event_id") % 10 == 0
    props = F.when(broken, F.concat(F.lit("{"), "props", F.lit("}{"))).otherwise(F.regexp_replace("props", r"\}$", ', "status": "ok"}'))
    return tables.parsed_documents(t(spark, d, "events").select("event_id", props.alias("props")), "props", "status string, k bigint", "status")


@query("""SELECT page_id, split_part(kv, '=', 1) AS key, substr(kv, instr(kv, '=') + 1) AS value FROM (SELECT page_id, trim(unnest(string_split(split_part(split_part(url, '?', 2), '#', 1), '&'))) AS kv FROM pages) WHERE kv <> '' AND contains(kv, '=') AND NOT starts_with(kv, '#')""")
def kv_parse(spark, d):
    tail = F.split_part(F.split_part("url", F.lit("?"), F.lit(2)), F.lit("#"), F.lit(1))
    rows = t(spark, d, "pages").select("page_id", F.explode(tables.settings_of(F.split(tail, "&"))).alias("kv"))
    return rows.select("page_id", "kv.key", "kv.value")


@query("SELECT conv_id, string_agg(CASE WHEN role IN ('user', 'assistant') THEN text END, '' ORDER BY turn) AS content FROM conversations GROUP BY 1")
def content_join(spark, d):
    part = F.struct("turn", F.col("role").alias("kind"), "text")
    listed = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
    text = text_rules.content_text(F.col("p"), ("user", "assistant"))
    return listed.select("conv_id", F.when(F.exists("p", lambda x: x["kind"].isin("user", "assistant")), text).alias("content"))


@query("SELECT conv_id, arg_min(text, turn) FILTER (role = 'system') AS system_text, arg_min(text, turn) FILTER (role = 'user') AS user_text, arg_min(text, turn) FILTER (role = 'assistant') AS assistant_text FROM conversations GROUP BY 1")
def variant_pivot(spark, d):
    turns = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("type"), "text"))).alias("p"))
    names = ("system", "user", "assistant")
    return turns.select("conv_id", variants.pivoted(F.col("p"), names).alias("v")).select("conv_id", *(F.get("v", F.lit(i)).alias(f"{n}_text") for i, n in enumerate(names)))


@query(f"SELECT conv_id, v[1 + CAST({HASH.format(k="CAST(conv_id AS VARCHAR) || '|1'", n='97')} AS BIGINT) % len(v)] AS training_text, v[1] AS validation_text FROM (SELECT conv_id, list(trim(text) ORDER BY turn) FILTER (trim(text) <> '') AS v FROM conversations GROUP BY 1)")
def variant_select(spark, d):
    listed = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("text")))).alias("p"))
    v = F.filter(F.transform("p", lambda x: F.trim(x["text"])), lambda x: x != "")
    one = lambda training: variants.chosen(v, F.col("conv_id"), F.lit(1), training)
    return listed.select("conv_id", one(True).alias("training_text"), one(False).alias("validation_text"))


@query("SELECT l_orderkey, count(*) AS n_samples, string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS samples FROM lineitem GROUP BY 1")
def nested_index(spark, d):
    rows = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("part"), "l_linenumber", "l_partkey", "l_suppkey")
    index = sinks.dataset_index(rows, "l_linenumber", ["l_partkey", "l_suppkey"])
    samples = F.from_json("document", "samples array<struct<l_linenumber:bigint,l_partkey:bigint,l_suppkey:bigint>>")["samples"]
    text = F.transform(samples, lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"], x["l_suppkey"]))
    return index.select(F.col("part").alias("l_orderkey"), F.col("n_samples").cast("long").alias("n_samples"), F.array_join(text, ",").alias("samples"))


@query(f"SELECT CAST(doc_id AS VARCHAR) AS sample_id, coalesce(source, '') AS artist, coalesce(reject_reason, '') AS review_reason FROM ({GATED}) WHERE reject_reason IN ('toxic', 'low_quality', 'language')")
def manual_review(spark, d):
    rows = gated(spark, d).where(nulls.is_in(F.col("reject_reason"), "toxic", "low_quality", "language"))
    return sinks.csv_rows(rows.select(F.col("doc_id").alias("sample_id"), F.col("source").alias("artist"), F.col("reject_reason").alias("review_reason")), ["sample_id", "artist", "review_reason"])


@query("SELECT doc_id, base64(encode(text)) AS encoded FROM documents")
def base64(spark, d):
    encoded = F.replace(F.base64(F.encode("text", "utf-8")), F.lit("\r\n"), F.lit(""))
    return t(spark, d, "documents").select("doc_id", encoded.alias("encoded"))


@query("SELECT n_nationkey, least(60.0, pow(2.0, n_nationkey)) AS pause, n_nationkey + 400 IN (408, 409) OR n_nationkey + 415 = 429 AS retryable FROM nation")
def backoff(spark, d):
    n = F.col("n_nationkey")
    code = F.when((n + 415) == 429, 429).otherwise(n + 400)
    return t(spark, d, "nation").select("n_nationkey", features.backoff_seconds(n).alias("pause"), code.isin(*features.RETRYABLE).alias("retryable"))


@query("SELECT coalesce(o.k, l.k) AS k, CASE WHEN l.k IS NULL THEN 'missing' WHEN o.k IS NULL THEN 'extra' ELSE 'matched' END AS status FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P') o FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON o.k = l.k")
def reconcile_sets(spark, d):
    expected = t(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"))
    return resume.reconciled(expected, t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


@query("SELECT count(*) AS n_collisions FROM (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1 INTERSECT SELECT l_orderkey FROM lineitem WHERE l_linenumber > 1)")
def part_collision(spark, d):
    rows = t(spark, d, "lineitem")
    both = rows.groupBy("l_orderkey").agg(F.max((F.col("l_linenumber") == 1).cast("int")).alias("a"), F.max((F.col("l_linenumber") > 1).cast("int")).alias("b"))
    return both.agg(F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("n_collisions"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orphans(spark, d):
    return resume.orphans(t(spark, d, "orders").select("o_orderkey"), t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query(r"SELECT name, count(*) AS n_rows FROM (SELECT split_part(split_part(regexp_extract(url, '([^/]*)/?$', 1), '?', 1), '#', 1) AS name FROM pages) GROUP BY 1 HAVING count(*) > 1")
def basename_collision(spark, d):
    name = F.split_part(F.split_part(F.regexp_extract("url", "([^/]*)/?$", 1), F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    return keys.repeated_keys(t(spark, d, "pages").select(name.alias("name")), "name")


@query("SELECT count(*) AS n_batches, round(avg(m), 6) AS mean_of_means FROM (SELECT avg(l_quantity) AS m FROM lineitem GROUP BY l_orderkey)")
def mean_of_means(spark, d):
    return folds.mean_of_means(t(spark, d, "lineitem"), "l_orderkey", "l_quantity").withColumn("mean_of_means", F.round("mean_of_means", 6))


@query("""WITH RECURSIVE m AS (SELECT o_orderpriority AS run, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS step, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) AS loss FROM orders GROUP BY 1, 2),
  c AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY step) AS i FROM m WHERE step % 3 = 0),
  f AS (SELECT run, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS step, CAST('inf' AS DOUBLE) AS loss, CAST('inf' AS DOUBLE) AS best_loss, CAST(0 AS BIGINT) AS best_step, 0 AS stale FROM (SELECT DISTINCT run FROM c) UNION ALL
    SELECT c.run, c.i, c.step, c.loss, CASE WHEN c.loss < f.best_loss - 1e-8 THEN c.loss ELSE f.best_loss END, CASE WHEN c.loss < f.best_loss - 1e-8 THEN c.step ELSE f.best_step END, CASE WHEN c.loss < f.best_loss - 1e-8 THEN 0 ELSE f.stale + 1 END
    FROM f JOIN c ON c.run = f.run AND c.i = f.i + 1)
  SELECT run, step, round(loss, 6) AS loss, round(best_loss, 6) AS best_loss, best_step, stale, stale >= 4 AS stop FROM f WHERE i > 0""")
def early_stopping(spark, d):
    step = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("long")
    monthly = t(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("run"), step.alias("step")).agg((F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("double") / F.count("*")).alias("loss"))
    out = folds.tracked(monthly, ["run"], "step", "loss", every=3, patience=4)
    return out.withColumns({c: F.round(c, 6) for c in ("loss", "best_loss")})


@query(f"""WITH g AS (SELECT sha256(text) AS g, count(*) AS n FROM documents GROUP BY 1), o AS (SELECT g, coalesce(sum(n) OVER (ORDER BY sha256('42|' || g), g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
  SELECT CASE WHEN before < (SELECT round_even(count(*) * 0.15, 0) FROM documents) THEN 'validation' ELSE 'train' END AS split, coalesce(reject_reason, 'accepted') AS status, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM ({GATED}) JOIN o ON sha256(text) = g GROUP BY 1, 2""")
def flagship(spark, d):
    rows = gated(spark, d).select("doc_id", "reject_reason", F.length("text").alias("n"), F.sha2("text", 256).alias("shared"))
    split = folds.group_split(rows, "shared", 0.15)
    return split.groupBy("split", F.coalesce("reject_reason", F.lit("accepted")).alias("status")).agg(F.count("*").alias("n_rows"), F.sum("n").alias("n_chars"))


TAXONOMY = {"primary_genres": ["en", "de", "src0", "src3"], "style_families": ["en", "fr"], "moods": ["calm"], "instruments": ["piano", "unknown"], "instrument_roles": ["lead"]}


@query(r"""WITH r AS (SELECT doc_id, lang, source, doc_id % 12 / 10.0 AS sure, trim(CASE WHEN doc_id % 4 = 0 THEN 'Instrumental ' ELSE '' END || substr(text, 1, 300)) AS caption, split_part(text, ' ', 2) || ' feat. ' || source AS artist FROM documents),
  v AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'another' ELSE caption END AS whole, lower(caption || chr(10) || CASE WHEN doc_id % 7 = 0 THEN 'another' ELSE caption END || chr(10) || 'a' || chr(10) || 'b 90 bpm' || chr(10) || 'c') AS every, len(regexp_extract_all(caption, '[\p{L}\p{N}\p{M}_''-]+')) AS n,
    list_transform(list_filter(regexp_split_to_array(artist, '(?i)\b(?:feat\.?|ft\.?|and)\b|[&,/+|]'), lambda x: length(trim(x)) >= 4), lambda x: lower(trim(regexp_replace(x, '\s+', ' ', 'g')))) AS names FROM r)
  SELECT doc_id, sure >= 0.7 AND len(e) = 0 AS accepted, array_to_string(e, ',') AS errors FROM (SELECT doc_id, sure, list_sort(list_distinct(list_filter([
    CASE WHEN NOT coalesce(lang IN ('en', 'de', 'src0', 'src3'), false) THEN 'invalid_primary_genre' END, CASE WHEN source NOT IN ('en', 'de', 'src0', 'src3') THEN 'invalid_secondary_genres' END, CASE WHEN lang NOT IN ('en', 'fr') THEN 'invalid_style_families' END,
    CASE WHEN doc_id % 6 = 1 THEN 'invalid_instrument' END, CASE WHEN doc_id % 3 <> 0 AND doc_id % 10 / 10.0 < 0.55 THEN 'low_confidence_instrument' END, CASE WHEN NOT n BETWEEN 40 AND 80 THEN 'canonical_caption_word_count:' || n END,
    CASE WHEN doc_id % 5 = 0 THEN 'caption_variant_types' END, CASE WHEN doc_id % 7 = 0 THEN 'full_variant_must_equal_canonical' END, 'bpm_leaked_into_caption', CASE WHEN len(list_filter(names, lambda x: contains(every, x))) > 0 THEN 'artist_name_in_caption' END,
    CASE WHEN NOT starts_with(lower(caption), 'instrumental') THEN 'canonical_caption_not_instrumental' END, CASE WHEN NOT sure BETWEEN 0 AND 1 THEN 'invalid_annotation_confidence' END], lambda x: x IS NOT NULL))) AS e FROM v)""")
def annotation_rules(spark, d):
    i = F.col("doc_id")
    caption = F.trim(F.concat(F.when(i % 4 == 0, "Instrumental ").otherwise(""), F.substring("text", 1, 300)))
    rows = t(spark, d, "documents").select("doc_id", "lang", "source", caption.alias("caption"), F.concat(F.split_part("text", F.lit(" "), F.lit(2)), F.lit(" feat. "), "source").alias("artist"))
    instrument = F.struct(F.when(i % 6 == 1, "kazoo").when(i % 3 == 0, "unknown").otherwise("piano").alias("name"), F.lit("lead").alias("role"), (i % 10 / 10.0).alias("confidence"))
    variant = lambda kind, text: F.struct(kind.alias("type"), text.alias("text"))
    texts = F.array(variant(F.lit("full"), F.when(i % 7 == 0, "another").otherwise(F.col("caption"))), variant(F.lit("composition"), F.lit("a")), variant(F.lit("production"), F.lit("b 90 BPM")), variant(F.when(i % 5 == 0, "full").otherwise("tags"), F.lit("c")))
    result = F.struct(F.col("lang").alias("primary_genre"), F.array("source").alias("secondary_genres"), F.array("lang").alias("style_families"), F.lit(None).cast("array<string>").alias("moods"), F.array(instrument).alias("main_instruments"), F.col("caption").alias("canonical_caption"), texts.alias("caption_variants"), (i % 12 / 10.0).alias("annotation_confidence"))
    checked = rows.select("doc_id", "artist", result.alias("r")).select("doc_id", "r", annotation.errors(F.col("r"), F.col("artist"), TAXONOMY).alias("e"))
    return checked.select("doc_id", annotation.accepted(F.col("r"), F.col("e")).alias("accepted"), F.array_join("e", ",").alias("errors"))


@query("""WITH v AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'instrumental' WHEN 'de' THEN 'vocal_chops' ELSE 'lyrics' END AS vocal, n_chars FROM documents),
  f AS (SELECT doc_id, quality = 1 AS done, CASE WHEN quality = 1 THEN CASE WHEN toxic = 1 THEN 'lyrics' ELSE 'instrumental' END END AS vocal FROM labels), c AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'lyrics' ELSE 'vocal_chops' END AS vocal FROM labels WHERE doc_id % 2 = 0),
  s AS (SELECT vec_id AS doc_id, CASE WHEN label < 5 THEN 'accepted' ELSE 'rejected' END AS status FROM embeddings),
  a AS (SELECT v.doc_id, v.n_chars, v.vocal = 'lyrics' AS lyric, f.doc_id IS NOT NULL AS hit, CASE WHEN v.vocal <> 'lyrics' THEN 'original' WHEN coalesce(f.done AND f.vocal = 'instrumental', false) THEN 'separated_full' WHEN coalesce(c.vocal = 'vocal_chops', false) THEN 'separated_clean'
    WHEN coalesce(s.status = 'accepted', false) THEN 'clean_section' WHEN coalesce(c.vocal = 'lyrics' AND s.status = 'rejected', false) THEN 'rejected' ELSE 'pending' END AS source, CASE WHEN v.vocal <> 'lyrics' THEN v.vocal END AS original, f.vocal AS full_recheck_status, c.vocal AS clean_recheck_status
    FROM v LEFT JOIN f ON v.doc_id = f.doc_id LEFT JOIN c ON v.doc_id = c.doc_id LEFT JOIN s ON v.doc_id = s.doc_id)
  SELECT doc_id, source AS audio_source, CASE WHEN source IN ('pending', 'rejected') THEN source WHEN doc_id % 11 = 0 THEN 'pending' ELSE 'accepted' END AS quality_status, CASE WHEN source = 'pending' THEN CASE WHEN lyric AND hit THEN 'needs_clean_separation' ELSE 'vocal_check_incomplete' END WHEN source <> 'rejected' AND doc_id % 11 = 0 THEN 'selected_source_missing' END AS pending_reason,
    CASE source WHEN 'original' THEN original WHEN 'separated_full' THEN 'instrumental' WHEN 'separated_clean' THEN 'vocal_chops' WHEN 'clean_section' THEN 'instrumental' END AS vocal_status_after_processing, CASE source WHEN 'separated_full' THEN 'instrumental_full' WHEN 'separated_clean' THEN 'instrumental_clean' WHEN 'clean_section' THEN 'instrumental_clean+checked_section' END AS separator_preset,
    CASE source WHEN 'clean_section' THEN 60.5 ELSE CAST(n_chars AS DOUBLE) END AS duration, source = 'pending' AND lyric AS clean_target, CASE WHEN source = 'rejected' THEN 'lyrics_remain_and_no_checked_clean_section' END AS reject_reason, full_recheck_status, clean_recheck_status FROM a""")
def select_training(spark, d):
    sid, done = F.col("doc_id").cast("string").alias("sample_id"), F.lit("complete").alias("classification_status")
    path = lambda kind: F.concat(F.lit(f"/{kind}/"), F.col("doc_id").cast("string")).alias("canonical_path")
    docs, labels = t(spark, d, "documents").select("doc_id", "lang", "n_chars"), t(spark, d, "labels")
    vocal = docs.select(sid, "doc_id", F.when(F.col("lang") == "en", "instrumental").when(F.col("lang") == "de", "vocal_chops").otherwise("lyrics").alias("vocal_status"), path("a"), F.col("n_chars").cast("double").alias("duration"))
    full = labels.select(sid, F.when(F.col("quality") == 1, "complete").otherwise("failed").alias("classification_status"), F.when(F.col("quality") == 1, F.when(F.col("toxic") == 1, "lyrics").otherwise("instrumental")).alias("vocal_status"), path("f"))
    clean = labels.where("doc_id % 2 = 0").select(sid, done, F.when(F.col("doc_id") % 4 == 0, "lyrics").otherwise("vocal_chops").alias("vocal_status"), path("c"))
    search = t(spark, d, "embeddings").withColumn("doc_id", F.col("vec_id")).select(sid, F.when(F.col("label") < 5, "accepted").otherwise("rejected").alias("search_status"), F.lit(10.0).alias("section_start"), F.lit(70.5).alias("section_end"), path("s"), F.lit("instrumental").alias("vocal_status"))
    files = docs.where("doc_id % 11 <> 0").select(F.explode(F.array(*(path(k) for k in "afcs"))).alias("path"))
    out = curation.select(vocal, full, clean, search, files)
    return out.select("doc_id", "audio_source", "quality_status", "pending_reason", "vocal_status_after_processing", "separator_preset", "duration", "clean_target", "reject_reason", "full_recheck_status", "clean_recheck_status")


def listed_counts(value: str, source: str) -> str:
    return f"(SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT coalesce({value}, '') AS k, count(*) AS n FROM {source} GROUP BY 1))"


@query(f"""SELECT (SELECT count(*) FROM documents) AS audio_records, (SELECT count(*) FROM documents WHERE n_chars >= 500) AS audio_valid, (SELECT count(*) FROM documents WHERE NOT coalesce(n_chars >= 500, false)) AS audio_rejected, false AS deduplication_performed, (SELECT count(*) FROM documents) AS vocal_records, {listed_counts("lang", "documents")} AS vocal_status,
  (SELECT count(*) FROM conversations) AS training_records, {listed_counts("role", "conversations")} AS training_sources, (SELECT count(*) FROM labels WHERE quality = 0) AS training_rejected, (SELECT count(*) FROM events) AS mir_files, {listed_counts("event_type", "events")} AS mir_status,
  (SELECT count(*) FROM labels) AS annotation_state_records, {listed_counts("CAST(quality AS VARCHAR)", "labels")} AS annotation_status, (SELECT count(*) FROM pages) AS annotation_files, (SELECT count(*) FROM part) AS final_audio, (SELECT count(*) FROM supplier) AS tensors""")
def stage_status(spark, d):
    docs, labels = t(spark, d, "documents").select("lang", (F.col("n_chars") >= 500).alias("audio_valid")), t(spark, d, "labels")
    out = stages.status(
        docs, docs.select(F.col("lang").alias("vocal_status")), t(spark, d, "conversations").select(F.col("role").alias("audio_source")), labels.where("quality = 0"), t(spark, d, "events").select(F.col("event_type").alias("analysis_status")),
        labels.select(F.col("quality").cast("string").alias("annotation_status")), t(spark, d, "pages").select("page_id"), t(spark, d, "part").select("p_partkey"), t(spark, d, "supplier").select("s_suppkey"),
    )
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.withColumns({c: text(c) for c in ("vocal_status", "training_sources", "mir_status", "annotation_status")})


MERGED = """WITH e AS (SELECT DISTINCT l_orderkey AS stem, 0 AS part FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 2 = 0 UNION SELECT DISTINCT l_orderkey, 1 FROM lineitem WHERE l_linenumber = 2 AND l_orderkey % 3 = 0),
  a AS (SELECT o_orderkey AS stem, 0 AS part FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus <> 'P'),
  m AS (SELECT coalesce(e.part, a.part) AS part, CAST(coalesce(e.stem, a.stem) AS VARCHAR) AS stem, CASE WHEN a.stem IS NULL THEN 'missing' ELSE 'extra' END AS status FROM e FULL JOIN a ON e.stem = a.stem AND e.part = a.part WHERE e.stem IS NULL OR a.stem IS NULL
    UNION ALL SELECT min(part), CAST(stem AS VARCHAR), 'collision' FROM e GROUP BY stem HAVING count(*) > 1)"""


def merged(spark, d):
    stem = lambda df, c: df.select(F.col(c).cast("string").alias("stem"))
    items, orders = t(spark, d, "lineitem"), t(spark, d, "orders")
    expected = {0: stem(items.where("l_linenumber = 1 AND l_orderkey % 2 = 0"), "l_orderkey"), 1: stem(items.where("l_linenumber = 2 AND l_orderkey % 3 = 0"), "l_orderkey")}
    actual = {0: stem(orders.where("o_orderkey % 2 = 0"), "o_orderkey"), 1: stem(orders.where("o_orderkey % 3 = 0 AND o_orderstatus <> 'P'"), "o_orderkey")}
    return stages.merge(expected, actual)


@query(f"{MERGED} SELECT part, stem, status FROM m")
def merge_differences(spark, d):
    return merged(spark, d)[0]


@query(f"""{MERGED} SELECT (SELECT count(*) FROM e WHERE part = 0) AS part0_expected, (SELECT count(*) FROM e WHERE part = 1) AS part1_expected, (SELECT count(DISTINCT stem) FROM e) AS train_expected, (SELECT count(DISTINCT stem) FROM a) AS merged_tensors, (SELECT count(*) FROM m) AS n_errors,
  CASE WHEN (SELECT count(*) FROM m) = 0 THEN 'pass' ELSE 'failed' END AS status, false AS deduplication_performed""")
def merge_report(spark, d):
    return merged(spark, d)[1]


@query(SQL["q_early_stopping"])
def tracker_resume(spark, d):
    # the second half goes on from the state that the first one ended with
    step = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("long")
    monthly = t(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("run"), step.alias("step")).agg((F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("double") / F.count("*")).alias("loss"))
    track = lambda rows, state=None: folds.tracked(rows, ["run"], "step", "loss", every=3, patience=4, state=state)
    first = track(monthly.where("step < 23950"))
    out = first.unionByName(track(monthly.where("step >= 23950"), resume.latest(first, ["run"], F.col("step"))))
    return out.withColumns({c: F.round(c, 6) for c in ("loss", "best_loss")})


@query(f"""WITH s AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'Drop' WHEN 'assistant' THEN 'Theme' END AS label FROM ({TURNS}) WHERE role IN ('user', 'assistant') AND least(400, "end") - greatest(100, start) > 1),
  k AS (SELECT conv_id, turn, label FROM (SELECT *, lag(label) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM s) WHERE label IS DISTINCT FROM before)
  SELECT c.conv_id, coalesce(string_agg(label, '>' ORDER BY turn), '') AS labels FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN k ON c.conv_id = k.conv_id GROUP BY 1""")
def window_labels(spark, d):
    label = features.lookup({"user": "Drop", "assistant": "Theme"}, F.col("role"), "Noise")
    listed = turns(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", label.alias("label"), "start", "end"))).alias("s"))
    return listed.select("conv_id", F.array_join(features.window_labels(F.col("s"), F.lit(100), F.lit(400)), ">").alias("labels"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment <> '' AND c_nationkey % 5 <> 0 AND c_acctbal / 10000 >= 0.65 THEN c_mktsegment || ' ' || CASE WHEN c_nationkey % 2 = 0 THEN 'major' ELSE 'minor' END END AS keyscale FROM customer")
def key_threshold(spark, d):
    scale = F.when(F.col("c_nationkey") % 5 == 0, "").when(F.col("c_nationkey") % 2 == 0, "major").otherwise("minor")
    return t(spark, d, "customer").select("c_custkey", features.key_above(F.col("c_mktsegment"), scale, F.col("c_acctbal") / 10000, 0.65).alias("keyscale"))


#: Labels as recorded answers of a classifier: low quality is told with an action that doesn't fit, no label is no answer.
HEARD = "CASE WHEN toxic = 1 THEN 'lyrics' ELSE 'instrumental' END"


@query(f"""SELECT d.doc_id, CASE WHEN quality = 1 THEN 'complete' ELSE 'failed' END AS status, CASE WHEN quality = 1 THEN {HEARD} END AS vocal_status, CASE WHEN l.doc_id IS NULL THEN '404 no recorded answer' WHEN quality = 0 THEN 'validation:inconsistent_action' END AS error, CASE WHEN quality = 0 THEN 2 ELSE 1 END AS attempts,
  'recorded' AS model, CASE WHEN quality = 1 THEN CAST(n_chars AS BIGINT) END AS used, true AS dated FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE n_chars >= 200""")
def classify_stage(spark, d):
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    action = F.when(good == toxic, "separate_vocals").otherwise("keep_original")
    answer = F.to_json(F.struct(F.when(toxic, "lyrics").otherwise("instrumental").alias("vocal_status"), action.alias("recommended_action"), F.lit(0.5).alias("lyrics_prominence"), F.lit("heard").alias("reason"), F.struct(F.col("n_chars").alias("tokens")).alias("usage")))
    rows = t(spark, d, "documents").select("doc_id", "n_chars").join(t(spark, d, "labels"), "doc_id", "left")
    audio = rows.select("doc_id", F.col("doc_id").cast("string").alias("sample_id"), (F.col("n_chars") >= 200).alias("audio_valid"), F.when(F.col("toxic").isNotNull(), answer).alias("recorded"))
    out = stages.classify(audio, lambda: adapters.Recorded("recorded"), f"{shared_dir(spark)}/classified-{uuid.uuid4().hex}", attempts=2, sleep=lambda seconds: None, model="recorded")
    used = F.get_json_object("classification_usage", "$.tokens").cast("long")
    return out.select("doc_id", F.col("classification_status").alias("status"), "vocal_status", F.col("classification_error").alias("error"), F.col("classification_attempts").alias("attempts"), F.col("classification_model").alias("model"), used.alias("used"), F.col("classified_at").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T.*\+00:00$").alias("dated"))


BUILT = """WITH s AS (SELECT doc_id, n_chars / 10.0 AS duration, CASE WHEN doc_id % 3 > 0 THEN md5(text) END AS raw_path, coalesce(l.quality = 0, false) AS mono FROM documents d LEFT JOIN labels l USING (doc_id) WHERE n_chars >= 300), p AS (SELECT coalesce(raw_path, CAST(doc_id AS VARCHAR)) AS g, * FROM s), g AS (SELECT g, count(*) AS n FROM p GROUP BY 1),
  o AS (SELECT g, coalesce(sum(n) OVER (ORDER BY sha256('42|' || g), g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g),
  r AS (SELECT doc_id, duration, CASE WHEN before < (SELECT round_even(count(*) * 0.15, 0) FROM s) THEN 'validation' ELSE 'train' END AS split, CASE WHEN duration > 240 THEN 'overlength_audio_has_no_downbeats' WHEN mono THEN 'output_format_mismatch' END AS reason FROM p JOIN o USING (g))"""


def built(spark, d, annotated_only: str = "true") -> stages.Build:
    """Built from documents; labels say what a renderer answered: low quality came out in mono."""
    sid = F.col("doc_id").cast("string").alias("sample_id")
    docs = t(spark, d, "documents").where("n_chars >= 300").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    rendered = F.to_json(F.struct((F.col("n_chars") / 10.0).alias("duration"), F.lit(48000).alias("sample_rate"), F.when(F.coalesce(F.col("quality") == 0, F.lit(False)), 1).otherwise(2).alias("channels")))
    training = docs.select(sid, sid.alias("record_key"), (F.col("n_chars") / 10.0).alias("duration"), F.when(F.col("doc_id") % 3 > 0, F.md5("text")).alias("raw_path"), F.lit("accepted").alias("quality_status"), rendered.alias("rendered"))
    texts = F.array(*(F.struct(F.lit(k).alias("type"), F.lit(k).alias("text")) for k in annotation.VARIANTS))
    annotated = docs.where(annotated_only).select(sid, F.lit("accepted").alias("annotation_status"), F.struct(F.lit("full").alias("canonical_caption"), texts.alias("caption_variants")).alias("annotation"))
    sections = F.array(F.struct(F.lit("Intro").alias("label"), F.lit("intro").alias("raw_label"), F.lit(0.0).alias("start"), F.lit(20.0).alias("end")))
    mir = docs.select(sid, F.lit("complete").alias("analysis_status"), F.lit(120).alias("bpm"), F.lit("").alias("keyscale"), F.lit(None).cast("string").alias("timesignature"), F.array().cast("array<double>").alias("downbeats"), sections.alias("sections"))
    return stages.build(training, annotated, mir, lambda: adapters.Recorded("rendered"), f"{shared_dir(spark)}/built-{uuid.uuid4().hex}")


@query(f"""{BUILT} SELECT doc_id, split, duration AS final_duration, false AS trimmed, '[Intro]' || chr(10) || '[Instrumental]' || chr(10) AS lyrics, 'data/final_dataset/' || split || '/' || doc_id || '.lyrics.txt' AS path, 'instrumental' AS language, '120' AS bpm, 'full' AS caption,
  '["full","composition","production","tags"]' AS variants FROM r WHERE reason IS NULL""")
def build_records(spark, d):
    field = lambda name: F.get_json_object("document", f"$.{name}")
    return built(spark, d).records.select(F.col("sample_id").cast("long").alias("doc_id"), "split", "final_duration", "trimmed", "lyrics", F.col("final_lyrics_path").alias("path"), field("language").alias("language"), field("bpm").alias("bpm"), field("master_annotation.canonical_caption").alias("caption"), field("caption_variants").alias("variants"))


@query(f"""WITH RECURSIVE {BUILT.removeprefix("WITH ")}, w AS (SELECT CAST(round(duration * 1000) AS BIGINT) AS w, row_number() OVER (ORDER BY round(duration * 1000) DESC, CAST(doc_id AS VARCHAR)) AS i FROM r WHERE reason IS NULL AND split = 'train'),
  f AS (SELECT CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS b UNION ALL SELECT w.i, f.a + CASE WHEN f.a <= f.b THEN w.w ELSE 0 END, f.b + CASE WHEN f.a <= f.b THEN 0 ELSE w.w END FROM f JOIN w ON w.i = f.i + 1)
  SELECT count(*) AS input_records, count(*) FILTER (reason IS NULL) AS validated_records, count(*) FILTER (reason IS NULL AND split = 'train') AS train_records, count(*) FILTER (reason IS NULL AND split = 'validation') AS validation_records, count(*) FILTER (reason IS NOT NULL) AS n_errors,
  CASE WHEN count(*) FILTER (reason IS NOT NULL) = 0 THEN 'pass' ELSE 'failed' END AS status, (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM s GROUP BY raw_path)) AS shared_audio_records_preserved, false AS deduplication_performed,
  (SELECT round(max(a) / 3600000.0, 3) FROM f) AS part0_hours, (SELECT round(max(b) / 3600000.0, 3) FROM f) AS part1_hours FROM r""")
def build_report(spark, d):
    return built(spark, d).report.select("input_records", "validated_records", "train_records", "validation_records", "n_errors", "status", "shared_audio_records_preserved", "deduplication_performed", "part0_hours", "part1_hours")


@query("""SELECT CAST(d.doc_id AS VARCHAR) AS sample_id, CAST(d.doc_id AS VARCHAR) AS record_key, 'annotation_missing' AS reason, 'preflight_failed' AS status FROM documents d LEFT JOIN labels l USING (doc_id) WHERE n_chars >= 300 AND l.quality IS NULL""")
def build_preflight(spark, d):
    # samples without a label have no annotation: nothing is built
    out = built(spark, d, "quality IS NOT NULL")
    return out.errors.withColumn("status", F.lit(out.report.first()["status"]))


@query("SELECT conv_id, turn, CASE WHEN l.doc_id IS NULL THEN NULL ELSE l.toxic END AS toxic, l.doc_id IS NULL AS to_do FROM conversations c LEFT JOIN (SELECT * FROM labels WHERE quality = 1) l ON c.conv_id = l.doc_id")
def chunk_state(spark, d):
    prior = t(spark, d, "labels").select(F.col("doc_id").alias("conv_id"), F.when(F.col("quality") == 1, "complete").otherwise("failed").alias("status"), "toxic")
    return resume.reused(t(spark, d, "conversations").select("conv_id", "turn"), prior, ["conv_id"], "status").select("conv_id", "turn", "toxic", "to_do")


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS members, count(*) AS n_members, min(o_orderdate) AS first_seen FROM orders GROUP BY 1")
def group_members(spark, d):
    rows = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return folds.members(rows, ["o_custkey"], "o_orderkey", "o_orderdate").select("o_custkey", F.array_join("members", ",").alias("members"), "n_members", "first_seen")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'no_audio_stream' WHEN c_nationkey % 3 = 0 OR c_custkey % 7 = 0 THEN 'format_mismatch' WHEN abs(c_acctbal - round(c_acctbal)) > 0.4 THEN 'duration_mismatch' WHEN c_mktsegment = 'BUILDING' THEN 'full_decode_failed:BUILDING' END AS error FROM customer""")
def output_gate(spark, d):
    none, key = F.col("c_custkey") % 13 == 0, F.col("c_custkey")
    rate = F.when(none, None).when(F.col("c_nationkey") % 3 == 0, 44100).otherwise(48000)
    channels = F.when(none, None).when(key % 7 == 0, 1).otherwise(2)
    error = features.output_error(rate, channels, F.col("c_acctbal"), F.round("c_acctbal"), F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment")), 0.4)
    return t(spark, d, "customer").select("c_custkey", error.alias("error"))


@query("SELECT doc_id, n_chars % 3 > 0 OR n_chars % 5 < 4 AS trimmed FROM documents")
def trimmed_flag(spark, d):
    n = F.col("n_chars")
    return t(spark, d, "documents").select("doc_id", features.trimmed((n % 3).cast("double"), (n % 5).cast("double"), F.lit(4.0)).alias("trimmed"))


@query("SELECT conv_id, v[1 + CAST(conv_id % len(v) AS INTEGER)] AS state, length(v[1 + CAST(conv_id % len(v) AS INTEGER)]) AS mask FROM (SELECT conv_id, list(text ORDER BY turn) AS v FROM conversations WHERE text IS NOT NULL GROUP BY 1)")
def variant_with_mask(spark, d):
    listed = t(spark, d, "conversations").where("text IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("p"))
    masks = F.transform("p", lambda x: F.length(x["text"]).cast("long"))
    own = variants.selected(F.col("p.text"), masks, F.pmod("conv_id", F.size("p")).cast("int"))
    return listed.select("conv_id", own.alias("s")).select("conv_id", "s.state", "s.mask")
