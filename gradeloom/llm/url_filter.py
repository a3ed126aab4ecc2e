"""URL filters with redirect equivalence.

Rules (action, host, path) fit their host and its subdomains where the path starts with the rule's; the
longest wins, an allow among equally long ones.  Redirects and canonical links make urls aliases;
their connected components carry block decisions to all aliases, and a url's own rule goes first, so
an explicit allow stays an allow within a blocked component.

Rules meet urls in an equi-join on (host suffix, path prefix of a length that some rule has), so a host
with many rules or many urls is never multiplied out.  Everything is DataFrame functions.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
``#`` or the end.  Null urls and urls without ``://`` have empty ones, fit no rule and have no aliases.
Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import boxed, components, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'>\s]+)"

#: Entities that a link's url may hold, the ampersand last.
ENTITIES = (("(?i)&quot;|&#34;|&#x22;", '"'), ("(?i)&apos;|&#39;|&#x27;", "'"), ("(?i)&lt;|&#60;|&#x3c;", "<"),
            ("(?i)&gt;|&#62;|&#x3e;", ">"), ("(?i)&#47;|&#x2f;", "/"), ("(?i)&amp;|&#38;|&#x26;", "&"))


def with_host_and_path(frame: DataFrame, url: str = "url") -> DataFrame:
    """``frame`` with ``host`` and ``path`` of ``url``; columns of those names are replaced."""
    rest = frame.drop("host", "path").withColumn("_u", F.col(url)).withColumn(
        "_rest", F.expr("CASE WHEN instr(_u, '://') > 0 THEN substring(_u, instr(_u, '://') + 3) ELSE '' END"))
    raw = rest.withColumn("_h", F.regexp_extract("_rest", "^[^/?#]*", 0))
    return (raw.withColumn("host", F.translate("_h", UPPER, LOWER))
            .withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_h) + 1)"), "^[^?#]*", 0)).drop("_u", "_rest", "_h"))


def alias_key(url: Column, host: Column) -> Column:
    """A url without its fragment, with a lower-case host: what aliases are compared by."""
    bare = F.regexp_extract(url, r"(?s)^[^#]*", 0)
    scheme = F.substring_index(bare, "://", 1)
    after = F.length(scheme) + 4 + F.length(host)
    return F.when(host != "", F.concat(scheme, F.lit("://"), host, bare.substr(after, F.length(bare))))


def without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(
        x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc)).otherwise(F.array_append(acc, x)))
    # a path that ends with a dot segment names a folder
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))).otherwise(path)


def page_links(pages: DataFrame) -> DataFrame:
    """(url, target) of all canonical links and meta refreshes in ``html``, targets decoded, absolute and without dot segments."""
    tagged = pages.where(F.col("url").isNotNull() & F.col("html").rlike(r"(?i)canonical|http-equiv"))
    every = lambda pattern, k: F.regexp_extract_all("html", F.lit(pattern), F.lit(k))
    found = F.array_distinct(F.concat(*(every(CANONICAL, k) for k in (1, 2, 3)), every(REFRESH, 1)))
    named = F.trim(F.col("t"))
    for code, plain in ENTITIES:
        named = F.regexp_replace(named, code, plain)
    links = with_host_and_path(tagged.select("url", F.explode(found).alias("t")).withColumn("t", named).where("t <> ''"))
    scheme = F.substring_index("url", "://", 1)
    origin = F.concat(scheme, F.lit("://"), "host")
    folder = F.regexp_extract("path", r"^(?s:.*)/", 0)
    # the path of the target goes without dot segments, what follows it stays
    full = (F.when(F.col("t").contains("://"), F.col("t")).when(F.col("t").startswith("//"), F.concat(scheme, F.lit(":"), "t"))
            .when(F.col("t").startswith("/"), F.concat(origin, "t"))
            .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), "t")))
    head = F.regexp_extract("full", r"^[^?#]*?://[^/?#]*", 0)
    way = F.regexp_extract(F.expr("substring(full, length(head) + 1)"), r"^[^?#]*", 0)
    target = F.concat("head", without_dots(F.col("way")), F.expr("substring(full, length(head) + length(way) + 1)"))
    links = links.withColumn("full", full).withColumn("head", head).withColumn("way", way)
    return links.where("host <> ''").select("url", target.alias("target"))


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) for the distinct ``host`` and ``path`` of ``urls`` that some rule fits."""
    known = rules.select("action", F.translate(F.col("host"), UPPER, LOWER).alias("_rh"), F.col("path").alias("_rp"))
    lengths = sorted(r["n"] for r in known.select(F.length("_rp").alias("n")).distinct().collect())
    if not lengths:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action")).where("false")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.filter(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)), lambda p: p.isNotNull())
    keyed = (urls.where("host <> ''").select("host", "path").distinct()
             .select("host", "path", F.explode(suffixes).alias("_rh"), prefixes.alias("_p")).select("host", "path", "_rh", F.explode("_p").alias("_rp")))
    name = F.concat("_rh", "_rp")
    rank = F.struct(F.length(name), F.col("action") == "allow", name)
    return (keyed.join(known, ["_rh", "_rp"]).groupBy("host", "path")
            .agg(F.max_by(F.struct(name.alias("rule"), F.col("action")), rank).alias("_b")).select("host", "path", "_b.*"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has (action, host, path), ``links`` (url, target): by default those found in the pages.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "action string, host string, path string")
    parsed = with_host_and_path(pages.select(boxed(pages, "host", "path", "rule", "verdict").alias("_row"), "url"))
    links = page_links(pages.select("url", "html")) if links is None else links.select("url", "target")
    ends = with_host_and_path(links.where("url is not null and target is not null"))
    ends = ends.select(alias_key(F.col("url"), F.col("host")).alias("a"), "target")
    ends = with_host_and_path(ends, "target").select("a", alias_key(F.col("target"), F.col("host")).alias("b"), F.col("target").alias("url"))
    ends = written(ends.where("a is not null and b is not null").distinct(), "aliases")
    best = written(best_rules(parsed.select("host", "path").unionByName(with_host_and_path(ends.select("url")).select("host", "path")), rules), "rules")

    joined = components(ends.select("a", "b"))
    sides = with_host_and_path(joined.select(F.col("node").alias("url"), "component"))
    blocked = (sides.join(best, ["host", "path"]).where("action = 'block'").select("component").distinct())
    guilty = written(joined.join(blocked, "component", "left_semi").select(F.col("node").alias("_key")).distinct(), "blocked-aliases")

    key = alias_key(F.col("url"), F.col("host"))
    out = (parsed.join(best, ["host", "path"], "left").withColumn("_key", key)
           .join(guilty.withColumn("_hit", F.lit(True)), "_key", "left"))
    verdict = F.coalesce("action", F.when(F.col("_hit"), "block").otherwise("allow"))
    return out.select("_row.*", "host", "path", "rule", verdict.alias("verdict"))
