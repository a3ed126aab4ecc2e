"""Queries over stage state."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import graph as Gr
from gradeloom.operators import state as T
from gradeloom.plans.registry import query

_STALE = """
own AS (SELECT deck, stage, bool_or(digest_then IS NOT NULL) AS has_print,
   bool_or(digest_then IS DISTINCT FROM digest_now AND input <> '<code>') AS changed FROM stage_inputs GROUP BY deck, stage),
j AS (SELECT s.*, coalesce(has_print, false) AS has_print, coalesce(has_print AND changed, false) AS moved,
   status = 'ok' OR (stage = 'materialised' AND status = 'partial') AS passing FROM stage_state s LEFT JOIN own USING (deck, stage)),
st AS (SELECT a.*, a.has_print AND (a.moved OR EXISTS (SELECT 1 FROM j b WHERE b.deck = a.deck AND b.stage_idx < a.stage_idx
   AND b.status <> 'skipped' AND ((b.passing AND b.moved) OR NOT b.passing))) AS stale FROM j a)
"""
_REACH = """
gap AS (SELECT d.deck, min(CASE WHEN s.passing THEN 11 ELSE i END) AS gap FROM (SELECT DISTINCT deck FROM stage_state) d CROSS JOIN range(0, 11) r(i)
  LEFT JOIN (SELECT deck, stage_idx, status = 'ok' OR (stage = 'materialised' AND status = 'partial') AS passing FROM stage_state) s ON s.deck = d.deck AND s.stage_idx = i GROUP BY d.deck),
names AS (SELECT DISTINCT stage_idx, stage FROM stage_state),
reach AS (SELECT deck, gap - 1 AS reached_idx, coalesce(n.stage, '—') AS reached FROM gap LEFT JOIN names n ON n.stage_idx = gap - 1)
"""


@query("stage_staleness", "T2", "WITH " + _STALE + "SELECT deck, stage, stale, CASE WHEN status IN ('ok', 'partial') AND stale THEN 'stale' ELSE status END AS effective FROM st")
def stage_staleness(m):
    rows = T.effective_status(T.staleness(m["stage_state"], m["stage_inputs"]))
    return rows.select("deck", "stage", "stale", "effective")


@query("furthest_stage", "T1", "WITH " + _STALE + """,
eff AS (SELECT deck, stage, stage_idx, CASE WHEN status IN ('ok', 'partial') AND stale THEN 'stale' ELSE status END AS e FROM st),
gap AS (SELECT d.deck, min(CASE WHEN e.e = 'ok' OR (e.stage = 'materialised' AND e.e = 'partial') THEN 11 ELSE i END) AS gap
  FROM (SELECT DISTINCT deck FROM st) d CROSS JOIN range(0, 11) r(i) LEFT JOIN eff e ON e.deck = d.deck AND e.stage_idx = i GROUP BY d.deck)
SELECT coalesce(n.stage, '—') AS reached, count(*) AS n FROM gap LEFT JOIN (SELECT DISTINCT stage_idx, stage FROM stage_state) n ON n.stage_idx = gap - 1 GROUP BY 1""")
def furthest_stage(m):
    rows = T.effective_status(T.staleness(m["stage_state"], m["stage_inputs"]))
    return T.furthest(rows, "effective").groupBy("reached").agg(F.count(F.lit(1)).alias("n"))


@query("code_drift", "T3", """
SELECT i.deck, i.stage FROM stage_inputs i JOIN stage_state s USING (deck, stage)
WHERE i.input = '<code>' AND i.digest_then IS NOT NULL AND i.digest_then <> i.digest_now AND s.status = 'ok'""")
def code_drift(m):
    return T.code_drift(m["stage_state"], m["stage_inputs"])


@query("recover_archived", "T4", """
WITH cur AS (SELECT deck, stage, md5(string_agg(input || '=' || digest_now, ',' ORDER BY input)) AS inputs FROM stage_inputs WHERE input <> '<code>' GROUP BY deck, stage),
att AS (SELECT e.deck, e.stage, e.ord AS attempt, e.status, CASE WHEN e.k % 3 = 0 THEN 'other' ELSE c.inputs END AS inputs FROM run_events e JOIN cur c USING (deck, stage) WHERE e.event = 'stage_finished')
SELECT a.deck, a.stage, max(attempt) AS attempt FROM att a JOIN cur c USING (deck, stage, inputs) JOIN stage_state s USING (deck, stage)
WHERE a.status = 'ok' AND a.stage IN ('proposed', 'recipe', 'reconciled', 'solvable') AND s.status <> 'ok' GROUP BY 1, 2""")
def recover_archived(m):
    current = (m["stage_inputs"].where(F.col("input") != T.CODE_INPUT).groupBy("deck", "stage")
               .agg(F.md5(F.concat_ws(",", F.array_sort(F.collect_list(F.concat("input", F.lit("="), "digest_now"))))).alias("inputs")))
    attempts = (m["run_events"].where(F.col("event") == "stage_finished")
                .join(current, ["deck", "stage"])
                .select("deck", "stage", F.col("ord").alias("attempt"), "status",
                        F.when(F.col("k") % 3 == 0, "other").otherwise(F.col("inputs")).alias("inputs")))
    return T.recover_archived(m["stage_state"], attempts, current)


@query("module_closure", "T5", """
WITH e AS (SELECT parent, child FROM edges WHERE child % 23 <> 0 AND parent % 23 <> 0),
r AS (SELECT o_orderkey AS root, o_orderkey AS node FROM orders WHERE o_orderkey BETWEEN 1 AND 15
  UNION SELECT r.root, e.child FROM r JOIN e ON e.parent = r.node WHERE r.node % 29 <> 0)
SELECT root, count(*) AS modules, sha1(string_agg(node || ':' || md5(node::VARCHAR), chr(10) ORDER BY node || ':' || md5(node::VARCHAR))) AS digest FROM r GROUP BY root""")
def module_closure(m):
    nodes = m["orders"].select(F.col("o_orderkey").alias("node"))
    seeds = nodes.where(F.col("node").between(1, 15)).select(F.col("node").alias("root"), "node")
    closure = T.module_closure(m["edges"], seeds, nodes.where(F.col("node") % 29 == 0),
                               nodes.where(F.col("node") % 23 == 0))
    sources = nodes.select("node", F.md5(F.col("node").cast("string")).alias("digest"))
    return T.closure_digest(closure, sources)


_DECKS = "(SELECT DISTINCT deck, uid % 5 AS repairs, uid % 3 = 0 AS running FROM stage_state)"


@query("given_up", "T6", f"""
WITH d AS {_DECKS}, p AS (SELECT deck, min_by(stage, stage_idx) AS stage, min_by(status, stage_idx) AS status FROM stage_state WHERE status IN ('needs_human','crashed','failed','infra') GROUP BY deck),
r AS (SELECT deck, min_by(stage, stage_idx) AS stage FROM stage_state WHERE status = 'rejected' GROUP BY deck)
SELECT d.deck, coalesce(p.stage, r.stage) AS stage, coalesce(p.status, 'rejected') AS status, CASE WHEN p.deck IS NOT NULL THEN 'status' ELSE 'repair budget spent' END AS why
FROM d LEFT JOIN p USING (deck) LEFT JOIN r USING (deck) WHERE p.deck IS NOT NULL OR (r.deck IS NOT NULL AND NOT running AND repairs >= 3)""")
def given_up(m):
    return T.given_up(m["stage_state"], _decks(m))


def _decks(m):
    return m["stage_state"].select("deck", (F.col("uid") % 5).alias("repairs"), (F.col("uid") % 3 == 0).alias("running")).distinct()


@query("queue_view", "T7", "WITH " + _REACH + f""", d AS {_DECKS},
stop AS (SELECT d.deck FROM d WHERE EXISTS (SELECT 1 FROM stage_state s WHERE s.deck = d.deck AND s.status IN ('needs_human','crashed','failed','infra'))
  OR (NOT running AND repairs >= 3 AND EXISTS (SELECT 1 FROM stage_state s WHERE s.deck = d.deck AND s.status = 'rejected')))
SELECT d.deck, reached AS done_through, n.stage AS next, n.stage IS NULL AS finished,
  CASE WHEN n.stage IN ('proposed','recipe','reconciled','solvable') THEN 'agent' WHEN n.stage IS NOT NULL THEN 'cpu' END AS pool,
  d.deck IN (SELECT deck FROM stop) AS parked, n.stage IS NOT NULL AND NOT running AND d.deck NOT IN (SELECT deck FROM stop) AS queued
FROM d JOIN reach USING (deck) LEFT JOIN names n ON n.stage_idx = reached_idx + 1""")
def queue_view(m):
    return T.queue_view(m["stage_state"], _decks(m))


@query("batch_yield", "T8", "WITH " + _REACH + """
SELECT CASE WHEN reached_idx = 10 THEN 'packaged' ELSE reached || ' -> ' || coalesce(s.status, 'not started') END AS outcome, count(*) AS n
FROM reach LEFT JOIN stage_state s ON s.deck = reach.deck AND s.stage_idx = reached_idx + 1 GROUP BY 1""")
def batch_yield(m):
    return T.yield_counts(m["stage_state"])


@query("stage_durations", "T9", """
WITH p AS (SELECT *, last_value(at_ms IGNORE NULLS) OVER (PARTITION BY deck ORDER BY stage_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM stage_state),
d AS (SELECT stage, coalesce(duration_ms, at_ms - prev) AS ms, duration_ms IS NULL AND at_ms - prev IS NOT NULL AS derived FROM p)
SELECT stage, count(*) AS n, sum(ms)::BIGINT AS total_ms, count(*) FILTER (WHERE derived) AS derived, max(ms) AS max_ms, floor(quantile_cont(ms, 0.5))::BIGINT AS median_ms
FROM d WHERE ms >= 0 GROUP BY stage""")
def stage_durations(m):
    return T.duration_summary(T.stage_durations(m["stage_state"]))


@query("status_lists", "T10", """
SELECT deck, bool_or(status = 'rejected') AND NOT bool_or(stage = 'packaged' AND status = 'ok') AS sent_back,
 bool_or(stage = 'solvable' AND status = 'ok') AND NOT bool_or(stage = 'packaged' AND k % 2 = 0) AS naked,
 bool_or(status IN ('needs_human', 'crashed')) AS parked, CASE WHEN max(attempts) > 1 THEN max(attempts) ELSE 0 END AS api_attempts
FROM stage_state GROUP BY deck""")
def status_lists(m):
    bundles = m["stage_state"].groupBy("deck").agg(F.bool_or((F.col("stage") == "packaged") & (F.col("k") % 2 == 0)).alias("has_bundle"))
    return T.status_lists(m["stage_state"], bundles)


@query("models_used", "T11", "SELECT stage, model || CASE WHEN fallback THEN ' (fallback)' ELSE '' END AS label, count(*) AS n FROM stage_state GROUP BY 1, 2")
def models_used(m):
    return T.models_used(m["stage_state"])


@query("shipped", "V9", """
WITH r AS (SELECT deck, max(CASE WHEN stage = 'packaged' THEN status END) AS packaged, bool_or(k % 3 <> 0) AS has_review, min(CASE WHEN stage = 'scored' THEN CASE WHEN k % 4 = 0 THEN 0.5 ELSE 1.0 END END) AS gt, count(*) FILTER (WHERE attempts = 4) AS gaps FROM stage_state GROUP BY deck),
w AS (SELECT deck, CASE WHEN packaged IS DISTINCT FROM 'ok' THEN 'packaged is not ok' WHEN NOT has_review THEN 'no review' WHEN gt IS DISTINCT FROM 1.0 THEN 'scores are not 1 and 0' WHEN gaps > 0 THEN 'bundle has gaps' END AS why FROM r)
SELECT deck, why, why IS NULL AS shipped FROM w""")
def shipped(m):
    records = m["stage_state"].groupBy("deck").agg(
        F.max(F.when(F.col("stage") == "packaged", F.col("status"))).alias("packaged"),
        F.bool_or(F.col("k") % 3 != 0).alias("has_review"),
        F.min(F.when(F.col("stage") == "scored", F.when(F.col("k") % 4 == 0, 0.5).otherwise(1.0))).alias("gt_score"),
        F.lit(0.0).alias("input_score"), F.count_if(F.col("attempts") == 4).alias("bundle_gaps"))
    return T.shipped(records).select("deck", "why", "shipped")


@query("unwitnessed", "V10", """
SELECT deck, min_by(stage, stage_idx) AS stage FROM stage_state WHERE status = 'ok' AND stage IN ('proposed','recipe','reconciled','solvable')
 AND NOT (stage <> 'solvable' AND adopted) AND k % 5 <> 1 GROUP BY deck""")
def unwitnessed(m):
    return T.unwitnessed(m["stage_state"].withColumn("has_run", F.col("k") % 5 == 1))


@query("still_to_run", "R30", """
WITH d AS (SELECT deck, bool_and(status <> 'rejected') AS shipped, CASE WHEN max(uid) % 4 = 0 THEN 'parked' ELSE 'shipped' END AS outcome FROM stage_state GROUP BY deck)
SELECT deck, NULL::VARCHAR AS problem FROM d WHERE NOT (shipped AND outcome = 'shipped')
UNION ALL SELECT r.deck, CASE WHEN d.deck IS NULL THEN 'requested deck is absent' END FROM (SELECT DISTINCT 'deck' || lpad((user_id * 2)::VARCHAR, 9, '0') AS deck FROM events) r LEFT JOIN d USING (deck)""")
def still_to_run(m):
    decks = m["stage_state"].groupBy("deck").agg(
        F.bool_and(F.col("status") != "rejected").alias("shipped"),
        F.when(F.max("uid") % 4 == 0, "parked").otherwise("shipped").alias("outcome"))
    asked = m["events"].select(F.concat(F.lit("deck"), F.lpad((F.col("user_id") * 2).cast("string"), 9, "0")).alias("deck")).distinct()
    return T.still_to_run(decks).unionByName(T.still_to_run(decks, asked))


@query("reachable_parts", "A35", """
WITH r AS (SELECT 1::BIGINT AS node UNION SELECT e.child FROM r JOIN edges e ON e.parent = r.node)
SELECT o_orderkey AS node, o_orderkey IN (SELECT node FROM r) AS reached FROM orders""")
def reachable_parts(m):
    nodes = m["orders"].select(F.col("o_orderkey").alias("node"))
    roots = nodes.where(F.col("node") == 1).select(F.col("node").alias("root"), "node")
    hit = Gr.reachable(m["edges"], roots).select("node", F.lit(True).alias("hit"))
    return nodes.join(hit, "node", "left").select("node", F.coalesce("hit", F.lit(False)).alias("reached"))
