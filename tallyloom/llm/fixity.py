"""Merkle fixity audit of WARC replicas.

Pages are WARC records in files of FILE page ids each, in order of page_id, so every record has a file and an offset range. A leaf hashes a record's offset, length and digest; its place in the file's tree comes from its id, so a record that is missing leaves its place empty and moves no other. A node hashes its up to FAN children in order; a file's last node is its root, and roots of files form the upper tree in the same way. Two replicas are compared from the top: only children of nodes that differ are looked at, level by level, down to the records. There, records that are missing or extra, corrupt (another digest or length) or moved (their neighbours on both sides are others, among the records that both replicas have) are told from those that only lie further on because of these.

Trees and audits are DataFrame operations; WARC files are written by Spark's text writer (records end as lines would) and read as whole binary files.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import among, stored, table

FILE, FAN_BITS = 512, 4
#: Rows of a file above which its running sums are taken in parts.
HOT = 16 * FILE
END = "\r\n\r\n"


def _bodies(pages: DataFrame, damaged: Column | None) -> DataFrame:
    """page_id, body (a whole record but for its END) of pages."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col("url").cast("string"), F.lit("")), F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(END))
    body = F.concat(head, html)
    if damaged is not None:
        body = F.when(damaged, F.overlay(body, F.lit("#"), F.lit(1))).otherwise(body)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), body.alias("body"))


def _filed(rows: DataFrame) -> DataFrame:
    """rows (page_id, hash) with file and slot. Records without an id are dealt out by their hash to files below 0."""
    own, by = F.col("page_id").isNotNull(), F.xxhash64("hash")
    file = F.when(own, F.floor(F.col("page_id") / FILE).cast("long")).otherwise(-1 - F.pmod(by, F.lit(1024)))
    return rows.withColumns({"file": file, "slot": F.when(own, F.pmod("page_id", F.lit(FILE))).otherwise(F.pmod(F.shiftright(by, 16), F.lit(FILE)))})


def records(pages: DataFrame, damaged: Column | None = None) -> DataFrame:
    """page_id, file, place, start, length, hash of each record of pages (page_id, url, html; others are ignored).

    Null url and html count as empty; records with a null page_id go to file -1 - (hash of the record mod 1024); equal ids are in order of their hash; offsets count bytes. damaged: a condition on page_id under which the record's first byte is another (a replica's fault, for audits that must find it). A file that one id fills beyond HOT rows is summed up in parts by hash, equal rows as one.
    """
    body = F.concat("body", F.lit(END))
    rows = _filed(_bodies(pages, damaged).select("page_id", F.sha2(body, 256).alias("hash"), F.octet_length(body).cast("long").alias("length")))
    columns = ["page_id", "file", "place", "start", "length", "hash"]
    order = Window.partitionBy("file").orderBy("slot", "page_id", "hash")
    same = Window.partitionBy("file", "slot").orderBy("page_id", "hash")
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    rows = stored(rows, "hashed")
    hot = stored(rows.groupBy("file").agg(F.count("*").alias("n")).where(F.col("n") > HOT), "hot")
    few = rows if hot.isEmpty() else among(rows, hot, ["file"], "left_anti")
    few = few.withColumns({"place": F.col("slot") + FILE * (F.row_number().over(same).cast("long") - 1), "start": F.sum("length").over(upto(order)) - F.col("length")}).select(columns)
    if hot.isEmpty():
        return few
    bucket = F.conv(F.substring("hash", 1, 4), 16, 10).cast("long")
    many = among(rows, hot, ["file"]).groupBy("file", "slot", "page_id", "hash", "length").agg(F.count("*").alias("n")).withColumn("b", bucket)
    sums = many.groupBy("file", "slot", "b").agg(F.sum("n").alias("_n"), F.sum(F.col("n") * F.col("length")).alias("_bytes"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("file", "slot", "b", before("_n", Window.partitionBy("file", "slot").orderBy("b")).alias("_place"), before("_bytes", Window.partitionBy("file").orderBy("slot", "b")).alias("_start"))
    inner = Window.partitionBy("file", "slot", "b").orderBy("page_id", "hash")
    run = many.withColumns({"_i": before("n", inner), "_o": before(F.col("n") * F.col("length"), inner)}).join(starts, ["file", "slot", "b"])
    run = run.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    many = run.withColumns({"place": F.col("slot") + FILE * (F.col("_place") + F.col("_i") + F.col("_copy")), "start": F.col("_start") + F.col("_o") + F.col("_copy") * F.col("length")})
    return few.unionByName(many.select(columns))


def write_warc(pages: DataFrame, path: str, damaged: Column | None = None) -> str:
    """Pages as WARC files, path/file=<number>/<one part>.txt, in the order of records(); returns path."""
    rows = _bodies(pages, damaged)
    rows = _filed(rows.withColumn("hash", F.sha2(F.concat("body", F.lit(END)), 256)))
    rows.repartition("file").sortWithinPartitions("file", "slot", "page_id", "hash").select("file", "body").write.partitionBy("file").option("lineSep", END).text(path)
    return path


#: A record's header, whole and at its place; where a next one may begin.
_RECORD = re.compile(rb"WARC/1\.0\r\nWARC-Type: response\r\nWARC-Target-URI: [^\r\n]*\r\nWARC-Record-ID: <urn:page:(-?[0-9]*)>\r\nContent-Length: ([0-9]+)\r\n\r\n")
_NEXT = re.compile(rb"(?<=\r\n\r\n)WARC/1\.0\r\n")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["page_id", "file", "start", "length", "hash"], [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        for file, content in zip(batch.column(0), batch.column(1), strict=True):
            raw, at, out = content.as_py(), 0, []
            while at < len(raw):
                head = _RECORD.match(raw, at)
                end = head.end() + int(head[2]) + len(END) if head else 0
                if not head or end > len(raw) or raw[end - len(END) : end] != END.encode():
                    # a damaged header, or a length that isn't its own: it ends where a next record may begin
                    after = _NEXT.search(raw, at + 1)
                    end = after.start() if after else len(raw)
                body = raw[at:end]
                out.append((int(head[1]) if head and head[1] else None, file.as_py(), at, len(body), hashlib.sha256(body).hexdigest()))
                at = end
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds, strict=True)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """records() as they lie in the files of path: offsets and digests are those of the bytes there. A record whose header is damaged ends before the next WARC/1.0 after an empty line, and has no id; the records after it are read as they are. A task holds a file at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path)
    rows = files.select(F.regexp_extract("path", r"file=(-?[0-9]+)/[^/]*$", 1).cast("long").alias("file"), "content").mapInArrow(_parsed, "page_id long, file long, start long, length long, hash string")
    slots = _filed(rows.withColumnRenamed("file", "_file")).withColumn("file", F.col("_file"))
    same = Window.partitionBy("file", "slot").orderBy(F.col("page_id").asc_nulls_last(), "hash", "start")
    return slots.withColumn("place", F.col("slot") + FILE * (F.row_number().over(same).cast("long") - 1)).select("page_id", "file", "place", "start", "length", "hash")


@dataclass(frozen=True)
class Tree:
    """leaves: records(); nodes: level, a, b, hash; levels up to the files' roots, and above them. Up to the files' roots a node has a = file and b = place >> FAN_BITS * level; above, a is the file number shifted likewise and b 0."""

    leaves: DataFrame
    nodes: DataFrame
    inner: int
    outer: int


def tree(leaves: DataFrame) -> Tree:
    """The tree of records(), written to the shared folder level by level."""
    leaves = stored(leaves, "leaves")
    own = F.sha2(F.concat_ws(":", "start", "length", "hash"), 256)
    base = leaves.select(F.lit(0).alias("level"), F.col("file").alias("a"), F.col("place").alias("b"), own.alias("hash"))
    top = base.agg(F.max("b").alias("b"), F.min("a").alias("low"), F.max("a").alias("high")).first()
    inner = 0 if top["b"] is None else -(-int(top["b"]).bit_length() // FAN_BITS)
    outer, low, high = 0, top["low"] or 0, top["high"] or 0
    while low != high:
        low, high, outer = low >> FAN_BITS, high >> FAN_BITS, outer + 1
        if (low, high) == (-1, 0):  # files below 0 meet the others only at the root
            break
    out, level = base, base
    for i in range(1, inner + outer + 1):
        key = "b" if i <= inner else "a"
        up = level.select("a", "b", "hash").withColumn("child", F.col(key)).withColumn(key, F.shiftright(key, FAN_BITS) if (i < inner + outer or not outer) else F.lit(0).cast("long"))
        level = up.groupBy("a", "b").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("child", "hash"))), lambda c: F.concat_ws(":", c["child"], c["hash"])), ","), 256).alias("hash"))
        level = stored(level.select(F.lit(i).alias("level"), "a", "b", "hash"), "nodes")
        out = out.unionByName(level)
    return Tree(leaves, out, inner, outer)


def differing(mine: Tree, other: Tree) -> DataFrame:
    """file, place of the leaves that differ, found by descent. Replicas whose trees differ in height are compared from their leaves."""
    inner, outer = mine.inner, mine.outer
    found = None
    for level in range(inner + outer, -1, -1) if (inner, outer) == (other.inner, other.outer) else [0]:
        a, b = mine.nodes.where(F.col("level") == level).drop("level"), other.nodes.where(F.col("level") == level).drop("level").withColumnRenamed("hash", "other_hash")
        if found is not None:
            key = "b" if level < inner else "a"
            up = F.shiftright(key, FAN_BITS) if level + 1 < inner + outer or not outer else F.lit(0).cast("long")
            parents = found.select(F.col("a").alias("pa"), F.col("b").alias("pb"))
            on = (F.col("pa") == (up if key == "a" else F.col("a"))) & (F.col("pb") == (up if key == "b" else F.lit(0).cast("long")))
            a, b = a.join(parents, on, "left_semi"), b.join(parents, on, "left_semi")
        found = stored(a.join(b, ["a", "b"], "full").where(~F.col("hash").eqNullSafe(F.col("other_hash"))).select("a", "b"), "differing")
    return found.select(F.col("a").alias("file"), F.col("b").alias("place"))


def audit(mine: Tree, other: Tree) -> DataFrame:
    """file, place, kind, hash, other_hash (digests; null where a replica lacks the record) of what is wrong with the other replica: missing, extra, corrupt or moved. Records that only lie further on aren't reported. An unknown record where a missing one should begin, of the same length, is that one, corrupt: its header doesn't say whose it is."""
    found = differing(mine, other)
    renamed = {c: f"other_{c}" for c in ("start", "length", "hash")}
    columns = ["file", "place", "start", "length", "hash"]
    x = mine.leaves.select(columns).join(found, ["file", "place"], "left_semi")
    y = other.leaves.select(columns).join(found, ["file", "place"], "left_semi").withColumnsRenamed(renamed)
    both = stored(x.join(y, ["file", "place"], "full"), "found")
    same = F.col("hash").eqNullSafe(F.col("other_hash")) & F.col("length").eqNullSafe(F.col("other_length"))
    kind = F.when(F.col("other_hash").isNull(), "missing").when(F.col("hash").isNull(), "extra").when(~same, "corrupt")
    wrong = both.withColumn("kind", kind).where("kind IS NOT NULL")
    extra = wrong.where("kind = 'extra'").select("file", F.col("other_start").alias("start"), F.col("other_length").alias("length"), F.col("place").alias("_place"), F.col("other_hash").alias("_hash"))
    if not extra.isEmpty():
        pairs = stored(wrong.where("kind = 'missing'").select("file", "start", "length", "place", "hash").join(extra, ["file", "start", "length"]), "pairs")
        named = pairs.select("file", "place", F.lit("missing").alias("kind")).unionByName(pairs.select("file", F.col("_place").alias("place"), F.lit("extra").alias("kind")))
        told = pairs.select("file", "place", F.lit("corrupt").alias("kind"), "hash", F.col("_hash").alias("other_hash"))
        wrong = wrong.join(named, ["file", "place", "kind"], "left_anti").unionByName(told, allowMissingColumns=True)
    files = stored(both.where(same).select("file").distinct(), "files")
    if not files.isEmpty():
        common = among(mine.leaves.select(columns), files, ["file"]).join(among(other.leaves.select("file", "place", F.col("start").alias("other_start")), files, ["file"]), ["file", "place"])
        ends = {}
        for n, at in (("x", "start"), ("y", "other_start")):
            w = Window.partitionBy("file").orderBy(at, "place")
            ends |= {f"{n}b": F.lag("place").over(w), f"{n}a": F.lead("place").over(w)}
        apart = common.withColumns(ends).where("NOT xb <=> yb AND NOT xa <=> ya").select("file", "place")
        wrong = wrong.unionByName(both.where(same).join(apart, ["file", "place"], "left_semi").withColumn("kind", F.lit("moved")))
    return wrong.select("file", "place", "kind", "hash", "other_hash")


def op5_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, file, start, length, sha256 and intact of the WARC record of every page. The replica that is audited has a wrong byte in each record whose page_id leaves 13 when divided by 97; intact is what the audit says."""
    pages = table(spark, sf_dir, "pages")
    own = tree(records(pages))
    found = audit(own, tree(records(pages, F.col("page_id") % 97 == 13)))
    out = own.leaves.join(found.select("file", "place", F.lit(False).alias("same")), ["file", "place"], "left")
    return out.select("page_id", "file", "start", "length", F.col("hash").alias("sha256"), F.coalesce("same", F.lit(True)).alias("intact"))


OP5_SQL = r"""
WITH r AS (SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
    || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS body FROM pages),
h AS (SELECT page_id, page_id // 512 AS file, octet_length(encode(body)) AS length, sha256(body) AS sha256 FROM r)
SELECT page_id, file, CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id, sha256 ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS start, CAST(length AS BIGINT) AS length, sha256, page_id % 97 <> 13 AS intact FROM h
"""
