"""URL filters with redirect equivalence.

Rules of host and path prefix decide a page; a page that no rule fits takes the decision of its aliases. Aliases are the connected components over redirect edges (meta refresh, or a table of redirects) and canonical-link edges: such a page is blocked if a rule blocks some URL of its component and no rule allows one explicitly, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import ascii_lower, once, table
from tallyloom.llm.components import connected_components

#: Verdict, host, path. A rule fits its host and all subdomains if the path starts with the rule's; the longest wins.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: then up to ?, # or the end. Null or no ://: both empty."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits as struct(rule, verdict), else null. Rules are configuration and stand in the plan as literals."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        own = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, own) if out is None else out.when(fits, own)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def with_node(df: DataFrame, url: str, to: str) -> DataFrame:
    """df with the node of column url as column to, and its host and path as to_host and to_path: scheme and host lower-cased, no fragment, / for an empty path; null where there is no host."""
    host, path = host_path(F.col(url))
    df = once(df, **{f"{to}_host": host, f"{to}_path": path})
    host, path = F.col(f"{to}_host"), F.col(f"{to}_path")
    full = F.concat(F.lower(F.substring_index(url, "://", 1)), F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1))
    return once(df, **{to: F.when(host != "", full)})


def link_edges(pages: DataFrame) -> DataFrame:
    """a, b: nodes of a page's URL and of each target of its canonical links and meta refreshes. Relative targets are resolved against the page's URL."""
    found = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).where(F.col("url").isNotNull() & F.col("html").rlike(r"(?i)\b(?:canonical|refresh)\b"))
    found = once(found, tags=F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0)))
    canonical = F.filter("tags", lambda t: t.rlike(r"(?i)^<link\b.*\brel\s*=\s*[\"']?canonical\b"))
    refresh = F.filter("tags", lambda t: t.rlike(r"(?i)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"))
    targets = F.concat(
        F.transform(canonical, lambda t: F.regexp_extract(t, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)),
        F.transform(refresh, lambda t: F.regexp_extract(t, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1)),
    )
    found = with_node(found.select("url", F.explode(targets).alias("to")), "url", "a")
    to, scheme = F.replace("to", F.lit("&amp;"), F.lit("&")), F.substring_index("url", "://", 1)
    found = once(found, to=to, site=F.concat(scheme, F.lit("://"), "a_host"), folder=F.regexp_replace(F.when(F.col("a_path") == "", "/").otherwise(F.col("a_path")), r"[^/]*$", ""), scheme=scheme)
    to = F.col("to")
    full = (
        F.when(F.contains(to, F.lit("://")), to)
        .when(to.startswith("//"), F.concat("scheme", F.lit(":"), to))
        .when(to.startswith("/"), F.concat("site", to))
        .when(to != "", F.concat("site", "folder", to))
    )
    return with_node(once(found.select("a", "to", "site", "folder", "scheme"), full=full).select("a", "full"), "full", "b").select("a", "b").where("a <> b")


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (page_id, url, html; others are ignored). redirects: more edges (columns a, b: URLs).

    A null url has neither host, path nor aliases and is allowed; null html links nothing; repeated rows stay; an empty table gives none. Decisions of components are aggregates (any block, any allow), so a hub costs no more than its edges.
    """
    rows = with_node(pages.select("page_id", F.col("url").cast("string").alias("url")), "url", "node").withColumnsRenamed({"node_host": "host", "node_path": "path"})
    rows = once(rows, own=rule_of(F.col("host"), F.col("path"), rules))
    edges = link_edges(pages)
    if redirects is not None:
        more = redirects.select(F.col("a").alias("from"), F.col("b").alias("to"))
        edges = edges.unionByName(with_node(with_node(more, "from", "a"), "to", "b").select("a", "b"))
    members = connected_components(edges)
    host, path = host_path(F.col("node"))
    ruled = once(members, host=host, path=path)
    ruled = once(ruled, own=rule_of(F.col("host"), F.col("path"), rules))
    decided = ruled.groupBy("root").agg(F.max(F.coalesce(F.col("own.verdict") == "block", F.lit(False))).alias("blocks"), F.max(F.coalesce(F.col("own.verdict") == "allow", F.lit(False))).alias("allows"))
    blocked = members.join(decided.where("blocks AND NOT allows"), "root").select("node", F.lit(True).alias("aliased"))
    out = rows.join(blocked, "node", "left")
    verdict = F.coalesce(F.col("own.verdict"), F.when(F.col("aliased"), "block"), F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page; see judged() for nulls, empty texts and repeated rows."""
    return judged(table(spark, sf_dir, "pages"))


#: No page of the given tables declares a redirect or a canonical link, so rules and the default decide all of them there.
OP9_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE
  WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
