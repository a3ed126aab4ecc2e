"""Queries over publication tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import publication as U
from gradeloom.plans.registry import query

_DECKS = """SELECT deck, uid, max(CASE WHEN stage = 'packaged' THEN status END) AS packaged,
  CASE WHEN uid % 4 = 0 THEN 'parked' WHEN uid % 9 = 1 THEN NULL ELSE 'shipped' END AS outcome FROM {src} GROUP BY deck, uid"""
_D = "d AS (" + _DECKS.replace("{src}", "stage_state") + ")"


@query("approved_set", "U1", "WITH " + _D + """,
al AS (SELECT deck FROM d WHERE uid % 3 <> 0 UNION ALL SELECT 'deck' || lpad((uid + 1000000)::VARCHAR, 9, '0') FROM d WHERE uid % 10 = 0)
SELECT al.deck, coalesce(d.deck IS NOT NULL AND outcome = 'shipped' AND packaged = 'ok', false) AS approved, CASE WHEN d.deck IS NULL THEN 'allow-list names an unknown deck'
 WHEN outcome IS DISTINCT FROM 'shipped' THEN 'outcome is not shipped' WHEN packaged IS NULL THEN 'not packaged' WHEN packaged <> 'ok' THEN 'packaged is not ok' END AS reason FROM al LEFT JOIN d USING (deck)""")
def approved_set(m):
    decks = m.sql(_DECKS.replace("{src}", "{stage_state}"))
    allow = decks.where(F.col("uid") % 3 != 0).select("deck").unionByName(decks.where(F.col("uid") % 10 == 0).select(
        F.concat(F.lit("deck"), F.lpad((F.col("uid") + 1000000).cast("string"), 9, "0")).alias("deck")))
    return U.approved(decks, allow)


@query("shared_source_keys", "U2", """
SELECT checksum AS source_key, count(DISTINCT filename) AS claims, min(filename) AS first_deck FROM corpus_index WHERE checksum <> '' GROUP BY checksum HAVING count(DISTINCT filename) > 1""")
def shared_source_keys(m):
    rows = m["corpus_index"].where(F.col("checksum") != "").select(F.col("checksum").alias("source_key"), F.col("filename").alias("deck"))
    return U.shared_keys(rows)


_REG = """
keys AS (SELECT checksum AS source_key, min(ord) AS ord FROM corpus_index WHERE checksum <> '' GROUP BY checksum),
reg AS (SELECT source_key, 1000 + ord * 3 AS id FROM keys WHERE ord % 4 = 0),
res AS (SELECT 1000 + p_partkey * 7 AS id FROM part WHERE p_partkey % 2 = 0)
"""


def _registry(m):
    keys = (m["corpus_index"].where(F.col("checksum") != "").groupBy(F.col("checksum").alias("source_key"))
            .agg(F.min("ord").alias("ord")))
    reg = keys.where(F.col("ord") % 4 == 0).select("source_key", (F.lit(1000) + F.col("ord") * 3).alias("id"))
    reserved = m["part"].where(F.col("p_partkey") % 2 == 0).select((F.lit(1000) + F.col("p_partkey") * 7).alias("id"))
    return keys, reg, reserved


@query("allocate_ids", "U3", "WITH " + _REG + """,
nw AS (SELECT source_key, ord, row_number() OVER (ORDER BY ord) AS p FROM keys WHERE source_key NOT IN (SELECT source_key FROM reg)),
free AS (SELECT n AS id, row_number() OVER (ORDER BY n) AS p FROM range(1000, 1000 + (SELECT count(*) FROM keys) + (SELECT count(*) FROM reg) + (SELECT count(*) FROM res)) r(n) WHERE n NOT IN (SELECT id FROM reg) AND n NOT IN (SELECT id FROM res))
SELECT source_key, ord, id, true AS fresh, CASE WHEN id > 1800 THEN 'series is full' END AS problem FROM nw JOIN free USING (p)
UNION ALL SELECT source_key, ord, id, false, NULL FROM keys JOIN reg USING (source_key)""")
def allocate_ids(m):
    keys, reg, reserved = _registry(m)
    return U.allocate(keys, reg, reserved, 1000, 1800)


@query("registry_survey", "U4", "WITH " + _REG + """, occ AS (SELECT id FROM reg WHERE id % 5 <> 0 UNION ALL SELECT id + 1000000 FROM reg WHERE id % 8 = 0)
SELECT id, CASE WHEN reg.id IS NULL THEN 'present, not registered' ELSE 'registered, not present' END AS note FROM reg FULL JOIN occ USING (id) WHERE reg.id IS NULL OR occ.id IS NULL""")
def registry_survey(m):
    _, reg, _ = _registry(m)
    occ = reg.where(F.col("id") % 5 != 0).select("id").unionByName(reg.where(F.col("id") % 8 == 0).select((F.col("id") + 1000000).alias("id")))
    return U.survey(reg, occ)


@query("id_conflicts", "U5", "WITH " + _REG + """, occ AS (SELECT id, CASE CAST(floor(id / 12) AS BIGINT) % 4 WHEN 0 THEN source_key WHEN 1 THEN 'md5:other' WHEN 2 THEN NULL ELSE '' END AS source_key FROM reg WHERE id % 9 <> 2)
SELECT r.id, r.source_key, CASE WHEN coalesce(o.source_key, '') <> '' THEN 'held by another key' WHEN r.id % 6 = 4 THEN 'registered, holder unknown' ELSE 'occupied by an unknown file' END AS problem
FROM reg r JOIN occ o USING (id) WHERE o.source_key IS DISTINCT FROM r.source_key""")
def id_conflicts(m):
    _, reg, _ = _registry(m)
    occ = reg.where(F.col("id") % 9 != 2).select("id", F.expr("CASE CAST(floor(id / 12) AS BIGINT) % 4 WHEN 0 THEN source_key WHEN 1 THEN 'md5:other' WHEN 2 THEN NULL ELSE '' END AS source_key"))
    return U.conflicts(reg, occ, reg.where(F.col("id") % 6 == 4))


_FILES = """SELECT deck, path AS p0, w AS bytes, concat(CASE WHEN rn % 3 = 0 THEN 'assets/' WHEN rn % 3 = 1 THEN 'tests/assets/' ELSE '' END,
  CASE kind WHEN 'chart' THEN 'plan.json' WHEN 'table' THEN 'delta.json' WHEN 'picture' THEN 'img.png' ELSE concat('f', CAST(rn AS STRING), '.json') END) AS path, slide FROM {src}"""
_FL = "fl AS (" + _FILES.replace("{src}", "shapes_gt") + ")"


@query("route_files", "U6", "WITH " + _FL + """
SELECT target, leak, count(*) AS n, sum(length(destination))::BIGINT AS chars FROM (SELECT CASE WHEN starts_with(path, 'assets/') THEN 'dataset' ELSE 'repository' END AS target,
 CASE WHEN starts_with(path, 'assets/') THEN substr(path, 8) ELSE path END AS destination, path IN ('assets/plan.json', 'assets/delta.json') AS leak FROM fl) GROUP BY ALL""")
def route_files(m):
    routed = U.route_files(m.sql(_FILES.replace("{src}", "{shapes_gt}")))
    return routed.groupBy("target", "leak").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("destination")).alias("chars"))


@query("answer_text_leaks", "U6", "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def answer_text_leaks(m):
    return U.text_leaks(m["documents"], m["benchmark"])


@query("commit_batches", "U7", """
WITH RECURSIVE t AS (SELECT doc_id AS ord, row_number() OVER (ORDER BY doc_id) AS nth, 1 + n_chars % 130 AS files FROM documents),
w AS (SELECT ord, nth, files, files AS open, 0::BIGINT AS batch FROM t WHERE nth = 1
  UNION ALL SELECT t.ord, t.nth, t.files, CASE WHEN w.open + t.files > 90 THEN t.files ELSE w.open + t.files END, w.batch + CASE WHEN w.open + t.files > 90 THEN 1 ELSE 0 END FROM w JOIN t ON t.nth = w.nth + 1)
SELECT ord, files, batch FROM w""")
def commit_batches(m):
    tasks = m["documents"].select(F.col("doc_id").alias("ord"), (F.lit(1) + F.col("n_chars") % 130).alias("files"))
    return U.commit_batches(tasks, block=400)


@query("publish_totals", "U9", "WITH " + _FL + "SELECT CASE WHEN starts_with(path, 'assets/') THEN 'dataset' ELSE 'repository' END AS target, count(*) AS files, sum(bytes)::BIGINT AS bytes, count(DISTINCT deck) AS decks FROM fl GROUP BY 1")
def publish_totals(m):
    return U.publish_totals(U.route_files(m.sql(_FILES.replace("{src}", "{shapes_gt}"))))


@query("allocate_after_refusal", "U10", "WITH " + _REG + """,
ok AS (SELECT * FROM keys WHERE source_key NOT IN (SELECT checksum FROM corpus_index GROUP BY checksum HAVING count(DISTINCT filename) > 1)),
nw AS (SELECT source_key, ord, row_number() OVER (ORDER BY ord) AS p FROM ok WHERE source_key NOT IN (SELECT source_key FROM reg)),
free AS (SELECT n AS id, row_number() OVER (ORDER BY n) AS p FROM range(1000, 1000 + (SELECT count(*) FROM keys) + (SELECT count(*) FROM reg) + (SELECT count(*) FROM res)) r(n) WHERE n NOT IN (SELECT id FROM reg) AND n NOT IN (SELECT id FROM res))
SELECT source_key, id FROM nw JOIN free USING (p) UNION ALL SELECT source_key, id FROM ok JOIN reg USING (source_key)""")
def allocate_after_refusal(m):
    """Refused rows leave before ids are given out, so one allocation is already stable."""
    keys, reg, reserved = _registry(m)
    rows = m["corpus_index"].where(F.col("checksum") != "").select(F.col("checksum").alias("source_key"), F.col("filename").alias("deck"))
    clean = keys.join(U.shared_keys(rows), "source_key", "left_anti")
    return U.allocate(clean, reg, reserved, 1000, 10**12).select("source_key", "id")


_REPORTS = """SELECT ord, k % 17 = 0 AS timed_out, CASE WHEN k % 6 = 0 THEN 'ok' WHEN k % 7 = 0 THEN 'running' WHEN k % 11 = 0 THEN 'task_load_failed' ELSE 'setup_failed' END AS status, k % 13 <> 0 AS has_result, CASE WHEN k % 2 = 0 THEN 'ConnectionError: x' ELSE 'killed' END AS note, k % 12 = 0 AS success,
 CASE k % 8 WHEN 0 THEN 'AWS said VcpuLimitExceeded' WHEN 1 THEN 'server gave 502 Bad Gateway' WHEN 2 THEN 'Read timed out' WHEN 3 THEN '' WHEN 4 THEN 'HTTP 404 for url' ELSE 'setup failed' END AS message,
 CASE k % 5 WHEN 0 THEN 'FileNotFoundError: x' WHEN 1 THEN 'KeyError: y' ELSE '' END AS traceback,
 CASE WHEN k % 9 = 0 THEN 'caused by 403 Forbidden' ELSE 'nothing' END AS causes FROM {src}"""
_VERD = "rp AS (" + _REPORTS.replace("{src}", "run_events") + """),
vd AS (SELECT ord, CASE WHEN timed_out THEN 'infrastructure' WHEN NOT has_result THEN CASE WHEN note LIKE '%Connection%' THEN 'infrastructure' ELSE 'unattributed' END WHEN status = 'ok' AND success THEN 'ok'
  WHEN message LIKE '%Vcpu%' OR message LIKE '%502%' OR message = 'Read timed out' THEN 'infrastructure' WHEN message LIKE '%404%' THEN 'task_broken'
  WHEN traceback <> '' THEN 'task_broken' WHEN causes LIKE '%403%' THEN 'task_broken' WHEN status = 'running' THEN 'infrastructure' WHEN status = 'task_load_failed' THEN 'task_broken' ELSE 'unattributed' END AS verdict,
 NOT timed_out AND has_result AND NOT (status = 'ok' AND success) AND message LIKE '%Vcpu%' AS capacity FROM rp)"""


@query("failure_verdict", "U11", "WITH " + _VERD + "SELECT ord, verdict, capacity FROM vd")
def failure_verdict(m):
    return U.failure_verdict(m.sql(_REPORTS.replace("{src}", "{run_events}"))).select("ord", "verdict", "capacity")


@query("outcome_report", "U12", "WITH " + _VERD + "SELECT verdict, count(*) AS n, count(*) FILTER (WHERE capacity) AS capacity_refusals, verdict = 'ok' AS ships, verdict IN ('infrastructure', 'unattributed') AS unverified FROM vd GROUP BY verdict")
def outcome_report(m):
    return U.outcome_report(U.failure_verdict(m.sql(_REPORTS.replace("{src}", "{run_events}"))))
