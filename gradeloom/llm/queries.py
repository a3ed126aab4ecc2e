"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import (
    conversations,
    decontamination,
    embedding_dedup,
    license_scan,
    line_dedup,
    online_packing,
    packing,
    simhash,
    spelling,
    token_counts,
    toxicity,
    url_filter,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, as sentencepiece counts them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = token_counts.count_tokens(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query("op2_line_dedup", """
    WITH pages AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
    totals AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
    lines AS (SELECT DISTINCT source, text, trim(line, ' ' || chr(9) || chr(13)) AS line
              FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages)),
    common AS (SELECT l.source, l.line FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
               WHERE l.line <> '' GROUP BY l.source, l.line, t.total HAVING count(*) >= 3 AND count(*) > 0.05 * t.total),
    cut AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(1, len(string_split(text, chr(10))) + 1)) AS place FROM documents),
    marked AS (SELECT cut.*, common.line IS NOT NULL AS gone FROM cut
               LEFT JOIN common ON cut.source IS NOT DISTINCT FROM common.source
                               AND trim(cut.line, ' ' || chr(9) || chr(13)) = common.line)
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text,
           CAST(count(*) AS INTEGER) AS lines_before, CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS lines_dropped
    FROM marked GROUP BY doc_id""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.clean(documents, "source", ratio=0.05, least_pages=3).drop("source")


@query("op3_benchmark_decontamination")
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold, exactly or edited, at a similarity of 0.8 or more."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least=0.8, gram=3)


@query("op4_license_scan", license_scan.oracle())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every whole text."""
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: 3-word shingles, 64 bits, at most 3 bits apart."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, within=3)


@query("op6_warc", """
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, url, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
    SELECT page_id, url AS target, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM r""")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as sharded archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op7_embedding_near_dedup")
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors at a cosine of 0.9 or more."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


#: Action, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query("op9_url_filter", """
    WITH RECURSIVE rules(action, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
        ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    links AS (SELECT DISTINCT url, regexp_extract(html, '(?i)<link rel="canonical" href="([a-z]+://[^"]*)"', 1) AS target
              FROM pages WHERE url IS NOT NULL AND html ILIKE '%rel="canonical"%'),
    urls AS (SELECT DISTINCT url FROM (SELECT url FROM pages UNION ALL SELECT target FROM links WHERE target <> '') u WHERE url IS NOT NULL),
    rests AS (SELECT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM urls),
    hosts AS (SELECT url, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM rests),
    parsed AS (SELECT url, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM hosts),
    ranked AS (SELECT p.url, r.host || r.path AS rule, r.action,
                      row_number() OVER (PARTITION BY p.url ORDER BY length(r.host || r.path) DESC, r.action) AS n
               FROM parsed p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
    best AS (SELECT url, rule, action FROM ranked WHERE n = 1),
    edges AS (SELECT url AS a, target AS b FROM links WHERE target <> '' UNION SELECT target, url FROM links WHERE target <> ''),
    spread(url) AS (SELECT url FROM best WHERE action = 'block' UNION SELECT edges.b FROM edges JOIN spread ON edges.a = spread.url)
    SELECT p.page_id, coalesce(q.host, '') AS host, coalesce(q.path, '') AS path, best.rule,
           coalesce(best.action, CASE WHEN s.url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
    FROM pages p LEFT JOIN parsed q ON p.url = q.url LEFT JOIN best ON p.url = best.url
    LEFT JOIN (SELECT DISTINCT url FROM spread) s ON p.url = s.url""")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text; labels are learned outside the held-out third only."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model, threshold=0.7).select(
        "doc_id", (~toxicity.in_training()).alias("held_out"), "score", "predicted", "evidence")


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after planted damage."""
    return conversations.report(conversations.damage(table(spark, sf_dir, "conversations")))


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all whole texts with the spelling that each is a variant of."""
    return spelling.group_spellings(table(spark, sf_dir, "documents"), least_length=7, least_count=2, noise=31, least_times=10)


@query("op13_online_packing")
def op13_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 tokens without padding."""
    return online_packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)
