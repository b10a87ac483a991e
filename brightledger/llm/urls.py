"""URL rules whose decisions reach every alias: redirects and canonical links make urls equivalent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import ascii_lower, read
from brightledger.llm.components import connected_components
from brightledger.session import materialise

#: Rules of the registered query: host and path, and what they say.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What an url is known by: without its fragment, host in lower case. Null for texts that are no url."""
    scheme = ascii_lower(F.regexp_extract(url, r"(?s)\A(.*?)://", 1))
    rest = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host_of(url), F.when(rest == "", "/").otherwise(rest)))


def resolve(base: Column, link: Column) -> Column:
    """A link found on the page ``base`` as a full url; null for empty links."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(base, r"(?s)\A(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)\A(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)\A(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    slash = F.when(folder.endswith("/") & (F.length(folder) > F.length(site)), F.lit("")).otherwise(F.lit("/"))
    return F.when(link == "", None).when(F.instr(link, "://") > 0, link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link)).when(
        link.startswith("/"), F.concat(site, link)).otherwise(F.concat(folder, slash, link))


def _attribute(tag: Column, name: str) -> Column:
    found = [F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*{value}", 1) for value in ('"([^"]*)"', "'([^']*)'", "([^\\s\"'>]+)")]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in found])


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b): address of a page and of what its canonical link or its refresh leads to."""
    bare = F.regexp_replace("html", r"(?s)<!--.*?-->", "")
    tags = pages.filter("url is not null and html is not null").select("url", F.explode(F.regexp_extract_all(bare, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    canonical = F.when(F.array_contains(F.split(F.lower(_attribute(F.col("tag"), "rel")), r"\s+"), "canonical"), _attribute(F.col("tag"), "href"))
    refresh = F.when(F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh", F.regexp_extract(
        _attribute(F.col("tag"), "content"), r"(?is)\burl\s*=\s*['\"]?([^'\"]+)", 1))
    linked = tags.select("url", F.coalesce(canonical, refresh).alias("link")).filter("link <> ''")
    return linked.select(address(F.col("url")).alias("a"), address(resolve(F.col("url"), F.col("link"))).alias("b"))


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, rule_verdict) for every host and path of ``urls`` that a rule fits: the longest, allow before block.

    Only equality joins: each host's suffixes meet the rules' hosts, which know the lengths of their paths, then the path's
    beginnings of these lengths meet the rules.
    """
    rules = rules.filter("rule_host is not null and rule_path is not null").groupBy("rule_host", "rule_path").agg(
        F.min("rule_verdict").alias("rule_verdict"))
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    ends = urls.filter("host <> ''").select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("rule_host"))
    begun = ends.join(lengths, "rule_host").select("host", "path", "rule_host", F.explode("lengths").alias("n")).filter("length(path) >= n")
    fits = begun.withColumn("rule_path", F.substring(F.col("path"), F.lit(1), F.col("n"))).join(rules, ["rule_host", "rule_path"])
    best = F.struct((F.length("rule_host") + F.length("rule_path")).alias("size"), F.col("rule_host"), F.col("rule_path"), F.col("rule_verdict"))
    return fits.groupBy("host", "path").agg(F.max(best).alias("r")).select(
        "host", "path", F.concat("r.rule_host", "r.rule_path").alias("rule"), F.col("r.rule_verdict").alias("rule_verdict"))


def filtered(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict) for every row of ``pages`` (page_id, url, html; others are ignored).

    A page's own rule decides. Without one, its aliases do: urls joined by redirects (from_url, to_url) and by canonical links
    and refreshes of the pages, over any number of steps. An alias that a rule explicitly allows comes before any number that
    are blocked; a class without rules is allowed. Null and malformed urls have empty host and path, fit no rule and have
    no alias. Aliases that are no page of the table carry their rules' decisions as well.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select(address(F.col("from_url")).alias("a"), address(F.col("to_url")).alias("b")))
    roots = materialise(connected_components(links), "aliases")
    parts = [host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")]
    rows = pages.select("page_id", "url", *parts)
    members = roots.select("root", F.col("node").alias("url")).select("root", *parts)
    decided = materialise(ruled(rows.select("host", "path").unionByName(members.select("host", "path")), rules), "decided")
    classes = members.join(decided, ["host", "path"]).groupBy("root").agg(F.min("rule_verdict").alias("shared"))  # allow < block
    shared = materialise(roots.join(classes, "root").select(F.col("node").alias("_node"), "shared"), "shared")
    out = rows.join(decided, ["host", "path"], "left")
    # rows that need no alias get keys that meet nothing and lie in no one partition
    alone = F.concat(F.lit("no alias "), F.xxhash64("page_id", "url").cast("string"))
    out = out.join(shared, F.coalesce(F.when(out["rule"].isNull(), address(out["url"])), alone) == shared["_node"], "left")
    return out.select("page_id", "url", "host", "path", "rule", F.coalesce("rule_verdict", "shared", F.lit("allow")).alias("verdict"))


def op7_url_filter(spark, folder):
    rules = spark.createDataFrame(RULES, RULE_SCHEMA)
    return filtered(read(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return rf"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id, url,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
r(h, p, v) AS (VALUES {rules}),
f AS (SELECT rid, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
      FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN f USING (rid)"""


#: The given tables hold no redirect and no canonical link, so rules alone decide there; aliases are tested apart.
SQL = _sql()
