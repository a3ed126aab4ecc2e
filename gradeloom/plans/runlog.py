"""Queries over run events, timeline samples, sessions and supervision logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import runlog as R
from gradeloom.operators import defects as N
from gradeloom.plans.registry import query

_RUNS = """
mk AS (SELECT *, lag(event) OVER w AS pe, lag(ts) OVER w AS pts, lead(event) OVER w AS ne FROM run_events WHERE event IN ('stage_started', 'stage_finished')
  WINDOW w AS (PARTITION BY deck, stage ORDER BY us, ord)),
runs AS (SELECT deck, stage, status, coalesce(ms, CASE WHEN pe = 'stage_started' THEN floor((ts - pts) * 1000)::BIGINT END, 0) AS ms, CASE WHEN pe = 'stage_started' THEN pts END AS began, ord
  FROM mk WHERE event = 'stage_finished'
 UNION ALL SELECT deck, stage, 'running', 0, ts, ord FROM mk WHERE event = 'stage_started' AND ne IS NULL)
"""


@query("stage_runs", "R1", "WITH " + _RUNS + "SELECT deck, stage, status, ms, began, ord FROM runs")
def stage_runs(m):
    return R.stage_runs(m["run_events"]).select("deck", "stage", "status", "ms", "began", "ord")


@query("run_span", "R2", "SELECT min(ts) AS first_ts, max(ts) AS last_ts, round(max(ts) - min(ts), 3) AS seconds, max_by(event, us) AS last_event, bool_or(event = 'run_finished') AS ended FROM run_events")
def run_span(m):
    return R.run_span(m["run_events"]).withColumn("seconds", F.round("seconds", 3))


@query("stage_clock", "R3", "WITH " + _RUNS + """
SELECT stage, count(*) AS runs, sum(ms)::BIGINT AS busy_ms, max(ms) AS longest_ms, arg_min(deck, -ms * 100000000 + ord) AS longest_deck, median(ms)::DOUBLE AS median_ms FROM runs WHERE ms > 0 GROUP BY stage""")
def stage_clock(m):
    return R.stage_clock(R.stage_runs(m["run_events"]))


@query("pool_use", "R4", "WITH " + _RUNS + """
SELECT CASE WHEN stage IN ('proposed','recipe','reconciled','solvable') THEN 'agent' ELSE 'cpu' END AS pool, sum(ms)::BIGINT AS busy_ms,
  CASE WHEN stage IN ('proposed','recipe','reconciled','solvable') THEN round(sum(ms) / 1000 / ((SELECT max(ts) - min(ts) FROM run_events) * 8), 6) END AS used,
  CASE WHEN stage IN ('proposed','recipe','reconciled','solvable') THEN sum(ms) / 1000 / ((SELECT max(ts) - min(ts) FROM run_events) * 8) > 1.05 END AS impossible
FROM runs WHERE ms > 0 GROUP BY pool, stage IN ('proposed','recipe','reconciled','solvable')""")
def pool_use(m):
    use = R.pool_use(R.stage_runs(m["run_events"]), R.run_span(m["run_events"]), {"agent": 8, "cpu": None})
    return use.select("pool", "busy_ms", F.round("used", 6).alias("used"), "impossible")


@query("deck_endings", "R5", "WITH " + _RUNS + """,
p AS (SELECT deck, count(*) AS stages, sum(ms)::BIGINT AS busy_ms, arg_max(stage || ' ' || status, CASE WHEN status = 'running' THEN 1000000000000 ELSE 0 END + ord) AS ending FROM runs GROUP BY deck),
s AS (SELECT deck, count(*) AS skipped FROM run_events WHERE event = 'stage_skipped' GROUP BY deck)
SELECT deck, coalesce(stages, 0) AS stages, coalesce(skipped, 0) AS skipped, coalesce(busy_ms, 0) AS busy_ms, coalesce(ending, 'nothing to do') AS ending FROM p FULL JOIN s USING (deck)""")
def deck_endings(m):
    return R.deck_endings(m["run_events"], R.stage_runs(m["run_events"]))


@query("notable_events", "R6", """
WITH n AS (SELECT ord, us, deck, stage, CASE WHEN event = 'stage_retried' THEN 'retried after ' || coalesce(retry_kind, '?') ELSE status END AS what, nullif(why, '') AS why
 FROM run_events WHERE event = 'stage_retried' OR (event = 'stage_finished' AND status IN ('rejected','failed','infra','needs_human','crashed')))
(SELECT ord, deck, stage, what, why, NULL::BIGINT AS more FROM n ORDER BY us, ord LIMIT 40) UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, count(*) - 40 FROM n HAVING count(*) > 40""")
def notable_events(m):
    return R.notable_report(m["run_events"])


@query("skip_tally", "R7", "SELECT stage, why, count(*) AS n FROM run_events WHERE event = 'stage_skipped' GROUP BY ALL")
def skip_tally(m):
    return R.skip_tally(m["run_events"])


@query("at_moment", "R8", """
WITH t AS (SELECT * FROM run_events WHERE event IN ('stage_started', 'stage_finished') AND us <= 1705276800000000 QUALIFY row_number() OVER (PARTITION BY deck ORDER BY us DESC, ord DESC) = 1)
SELECT deck, stage, ts AS since FROM t WHERE event = 'stage_started'""")
def at_moment(m):
    return R.at_moment(m["run_events"], F.lit(1705276800000000))


_SESS = "d AS (SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY path, turns, output) = 1)"


@query("session_tokens", "R9", "WITH " + _SESS + """
SELECT stage, NULL::VARCHAR AS deck, count(*) AS sessions, sum(output)::BIGINT AS output, sum(input)::BIGINT AS input, round_even(sum(cost_usd), 4)::DOUBLE AS cost_usd, sum(turns)::BIGINT AS turns, sum(wall_ms)::BIGINT AS wall_ms, count(*) FILTER (WHERE is_error) AS errors FROM d GROUP BY stage
UNION ALL SELECT NULL, deck, count(*), sum(output)::BIGINT, sum(input)::BIGINT, round_even(sum(cost_usd), 4)::DOUBLE, sum(turns)::BIGINT, sum(wall_ms)::BIGINT, count(*) FILTER (WHERE is_error) FROM d GROUP BY deck""")
def session_tokens(m):
    once = R.distinct_sessions(m["sessions"])
    by_stage, by_deck = R.session_totals(once, ["stage"]), R.session_totals(once, ["deck"])
    return by_stage.unionByName(by_deck, allowMissingColumns=True)


_SPAN = """
g AS (SELECT *, lead(t) OVER (ORDER BY seq) - t AS gap FROM samples),
sp AS (SELECT * EXCLUDE gap, coalesce(gap, (SELECT median(gap) FROM g), 0)::DOUBLE AS span FROM g)
"""


@query("sample_spans", "R10", "WITH " + _SPAN + "SELECT seq, span FROM sp")
def sample_spans(m):
    return R.sample_spans(m["samples"]).select("seq", "span")


_LIMITS = """
said AS (SELECT 'agent' AS pool, agent_limit AS lim, agent_source AS src FROM samples UNION ALL SELECT 'cpu', cpu_limit, cpu_source FROM samples),
rk AS (SELECT pool, lim, src, CASE src WHEN 'flag' THEN 3 WHEN 'run-argv' THEN 2 END AS r FROM said WHERE lim IS NOT NULL AND src IN ('flag', 'run-argv')),
top AS (SELECT pool, count(DISTINCT lim) AS vals, max(lim) AS lim, max(src) AS src FROM rk WHERE r = (SELECT max(r) FROM rk x WHERE x.pool = rk.pool) GROUP BY pool),
lims AS (SELECT p.pool, CASE WHEN vals = 1 THEN lim END::BIGINT AS lim, CASE WHEN vals IS NULL THEN 'unknown' WHEN vals > 1 THEN 'conflicting' ELSE src END AS source FROM (VALUES ('agent'), ('cpu')) p(pool) LEFT JOIN top USING (pool))
"""


@query("resolve_limits", "R11", "WITH " + _LIMITS + "SELECT pool, lim AS \"limit\", source FROM lims")
def resolve_limits(m):
    return R.resolve_limits(m["samples"])


@query("pool_stats", "R12", "WITH " + _SPAN + "," + _LIMITS + """,
ld AS (SELECT seq, pool, count(*) FILTER (WHERE running) AS running, count(*) FILTER (WHERE queued) AS queued FROM sample_decks GROUP BY seq, pool),
rw AS (SELECT l.pool, lim, source, sp.span, coalesce(running, 0) AS running, coalesce(queued, 0) AS queued FROM sp CROSS JOIN lims l LEFT JOIN ld ON ld.seq = sp.seq AND ld.pool = l.pool),
a AS (SELECT pool, max(lim) AS lim, max(source) AS source, max(running) AS peak, max(queued) AS peak_queue, sum(span) AS wall, sum(running * span) AS busy, sum(queued * span) AS q, sum(CASE WHEN running >= lim THEN span ELSE 0 END) AS atl FROM rw GROUP BY pool),
k AS (SELECT *, CASE WHEN lim IS NULL OR peak <= lim THEN lim END AS kept FROM a)
SELECT pool, peak, peak_queue, kept AS "limit", CASE WHEN lim IS NOT NULL AND peak > lim THEN 'contradicted' ELSE source END AS limit_source, round_even(busy / wall, 2)::DOUBLE AS mean,
 round_even(busy / (wall * kept), 3)::DOUBLE AS utilisation, CASE WHEN kept IS NOT NULL THEN round_even(atl, 1)::DOUBLE END AS seconds_at_limit, round_even(q, 1)::DOUBLE AS queue_deck_seconds FROM k""")
def pool_stats(m):
    return R.pool_stats(R.sample_spans(m["samples"]), m["sample_decks"])


_IMPOSSIBLE = "coalesce(try_cast(nullif(regexp_extract(hung_why, 'no log output for ([0-9.]+)s', 1), '') AS DOUBLE) > since_s + 1, false)"


@query("deck_seconds", "R13", "WITH " + _SPAN + f""",
r AS (SELECT d.*, sp.span FROM sample_decks d JOIN sp USING (seq))
SELECT deck, sum(CASE WHEN running THEN span ELSE 0 END)::DOUBLE AS working_s, sum(CASE WHEN NOT running AND queued THEN span ELSE 0 END)::DOUBLE AS waiting_s,
 sum(CASE WHEN NOT running AND NOT queued THEN span ELSE 0 END)::DOUBLE AS idle_s, sum(CASE WHEN hung_why IS NOT NULL AND NOT {_IMPOSSIBLE} THEN span ELSE 0 END)::DOUBLE AS stalled_s,
 round_even(coalesce(min(CASE WHEN finished THEN t END), max_by(t + span, seq)) - (SELECT min(t) FROM sp), 1)::DOUBLE AS elapsed_s FROM r GROUP BY deck""")
def deck_seconds(m):
    return R.deck_seconds(R.sample_spans(m["samples"]), m["sample_decks"])


@query("critical_path", "R13", "WITH " + _SPAN + """,
r AS (SELECT d.*, sp.span FROM sample_decks d JOIN sp USING (seq)),
e AS (SELECT deck, round_even(coalesce(min(CASE WHEN finished THEN t END), max_by(t + span, seq)) - (SELECT min(t) FROM sp), 1)::DOUBLE AS elapsed_s FROM r GROUP BY deck)
SELECT deck, elapsed_s FROM e ORDER BY elapsed_s DESC, deck LIMIT 1""")
def critical_path(m):
    per = R.deck_seconds(R.sample_spans(m["samples"]), m["sample_decks"])
    return per.select("deck", "elapsed_s").orderBy(F.desc("elapsed_s"), "deck").limit(1)


@query("stage_seconds", "R14", "WITH " + _SPAN + """,
r AS (SELECT d.*, sp.span FROM sample_decks d JOIN sp USING (seq)),
w AS (SELECT stage, deck, sum(span) AS s FROM r WHERE running GROUP BY stage, deck),
t AS (SELECT stage, count(*) AS decks, sum(s) AS total_s, max(s) AS max_s, median(s) AS median_s FROM w GROUP BY stage),
q AS (SELECT stage, sum(span) AS wait_s FROM r WHERE NOT running AND queued GROUP BY stage)
SELECT stage, coalesce(decks, 0) AS decks, coalesce(total_s, 0)::DOUBLE AS total_s, coalesce(max_s, 0)::DOUBLE AS max_s, coalesce(median_s, 0)::DOUBLE AS median_s, coalesce(wait_s, 0)::DOUBLE AS wait_s FROM t FULL JOIN q USING (stage)""")
def stage_seconds(m):
    return R.stage_seconds(R.sample_spans(m["samples"]), m["sample_decks"])


@query("memory_report", "R15", """
SELECT max(rss_total) AS peak_rss, floor(avg(rss_total))::BIGINT AS mean_rss, arg_max(largest_name, largest_rss * 100000000 - seq) AS largest_name, max(largest_rss) AS largest_rss,
 min(avail) AS min_avail, arg_min(seq, avail * 100000000 + seq) AS min_avail_seq, max(displays_held) AS peak_displays, bool_or(saturated) AS ever_saturated FROM samples""")
def memory_report(m):
    return R.memory_report(m["samples"])


@query("stall_or_blind", "R16", f"""
SELECT deck, CASE WHEN {_IMPOSSIBLE} THEN 'blind' ELSE 'hung' END AS verdict, min(seq) AS first_seq, count(*) AS samples, min_by(hung_why, seq) AS why FROM sample_decks WHERE hung_why IS NOT NULL GROUP BY 1, 2""")
def stall_or_blind(m):
    return R.stall_report(m["sample_decks"])


@query("timeline_warnings", "R17", """SELECT warn, count(*) AS n FROM samples WHERE warn IS NOT NULL GROUP BY warn UNION ALL SELECT 'unattributed soffice', max(unattributed_soffice) FROM samples""")
def timeline_warnings(m):
    worst = m["samples"].agg(F.max("unattributed_soffice").alias("n")).select(F.lit("unattributed soffice").alias("warn"), "n")
    return R.warning_counts(m["samples"]).unionByName(worst)


@query("deck_transitions", "R18", """
WITH p AS (SELECT seq, lag(seq) OVER (ORDER BY seq) AS prev FROM samples),
j AS (SELECT d.*, w.stage AS ws, w.stage_idx AS wi, w.running AS wr, w.parked_status AS wp FROM sample_decks d JOIN p ON p.seq = d.seq AND p.prev IS NOT NULL LEFT JOIN sample_decks w ON w.seq = p.prev AND w.deck = d.deck)
SELECT seq, deck, stage, 'appeared' AS change FROM j WHERE ws IS NULL
UNION ALL SELECT seq, deck, stage, 'finished' FROM j WHERE stage_idx > wi
UNION ALL SELECT seq, deck, stage, CASE WHEN running THEN 'started' ELSE 'left' END FROM j WHERE ws IS NOT NULL AND (ws <> stage OR wr <> running)
UNION ALL SELECT seq, deck, stage, 'parked' FROM j WHERE ws IS NOT NULL AND parked_status IS NOT NULL AND wp IS NULL""")
def deck_transitions(m):
    return R.transitions(m["samples"], m["sample_decks"])


_COND = """
cond AS (SELECT seq, CASE WHEN hung_why LIKE '%dead pid%' THEN 'dead-lock' ELSE 'stall' END AS kind, deck AS id, 2 AS confirm FROM sample_decks WHERE hung_why IS NOT NULL
 UNION ALL SELECT seq, CASE WHEN parked_status = 'crashed' THEN 'crash' ELSE 'park' END, deck || '/' || stage, 1 FROM sample_decks WHERE parked_status IS NOT NULL
 UNION ALL SELECT seq, 'memory', '', 2 FROM samples WHERE avail < total * 0.993
 UNION ALL SELECT seq, 'displays', '', 2 FROM samples WHERE saturated
 UNION ALL SELECT seq, 'run-gone', '', 2 FROM samples s WHERE NOT has_roots AND EXISTS (SELECT 1 FROM sample_decks d WHERE d.seq = s.seq AND NOT finished AND parked_status IS NULL)),
num AS (SELECT seq, row_number() OVER (ORDER BY seq) AS nth FROM samples),
isl AS (SELECT c.*, nth, nth - row_number() OVER (PARTITION BY kind, id ORDER BY nth) AS grp FROM cond c JOIN num USING (seq)),
stk AS (SELECT *, row_number() OVER (PARTITION BY kind, id, grp ORDER BY nth) AS streak FROM isl)
"""


@query("edge_alerts", "R19", "WITH " + _COND + "SELECT seq, kind, id FROM stk WHERE streak = confirm")
def edge_alerts(m):
    days = m["samples"].select("seq", "day")
    cond = R.alert_conditions(m["samples"], m["sample_decks"], 0.993)
    return R.edge_alerts(days, cond)


@query("liveness", "R20", """
WITH l AS (SELECT seq, deck, stage, running, since_s, k % 11 <> 1 AS alive, CASE WHEN k % 7 = 0 THEN NULL ELSE (k * 17 % 1300)::DOUBLE END AS log_age FROM sample_decks)
SELECT seq, deck, CASE WHEN NOT alive THEN 'hung' WHEN NOT (running AND stage IN ('proposed','recipe','reconciled','solvable')) THEN NULL WHEN log_age > since_s + 1 THEN 'blind'
 WHEN log_age IS NULL AND since_s > 300 THEN 'blind' WHEN log_age > 300 THEN 'stalled' END AS verdict FROM l""")
def liveness(m):
    locks = m["sample_decks"].withColumn("lock_alive", F.col("k") % 11 != 1).withColumn(
        "log_age_s", F.when(F.col("k") % 7 == 0, None).otherwise((F.col("k") * 17 % 1300).cast("double")))
    return R.liveness(locks).select("seq", "deck", "verdict")


_LOGS = """
lg AS (SELECT line_no // 10000 AS log_id, line_no, us, CASE WHEN line_no % 10000 = 9000 THEN '### where it got to' WHEN k = 50 THEN '### run — eleven stages  [10:29:04]' WHEN k = 51 THEN 'wget 429 bytes' ELSE line END AS line FROM log_lines),
cut AS (SELECT log_id, min(line_no) AS c FROM lg WHERE contains(line, '### where it got to') OR contains(line, 'stages: 1·ingested') GROUP BY log_id),
dl AS (SELECT lg.*, regexp_extract(line, '^\\s{2}[·~]?\\s*(deck\\d+)\\s\\s+(.*?)\\s*$', 1) AS deck, regexp_extract(line, '^\\s{2}[·~]?\\s*(deck\\d+)\\s\\s+(.*?)\\s*$', 2) AS message
 FROM lg LEFT JOIN cut USING (log_id) WHERE (c IS NULL OR line_no < c) AND regexp_matches(line, '^\\s{2}[·~]?\\s*(deck\\d+)\\s\\s+(.*?)\\s*$'))
"""


def _logs(m):
    return m["log_lines"].selectExpr("line_no div 10000 AS log_id", "line_no", "us", """CASE WHEN line_no % 10000 = 9000 THEN '### where it got to'
      WHEN k = 50 THEN '### run — eleven stages  [10:29:04]' WHEN k = 51 THEN 'wget 429 bytes' ELSE line END AS line""")


@query("deck_lines", "R21", "WITH " + _LOGS + "SELECT line_no, deck, message FROM dl UNION ALL SELECT line_no, NULL, 'run — eleven stages @10:29:04' FROM lg WHERE line LIKE '### run%'")
def deck_lines(m):
    lines = R.deck_lines(_logs(m)).select("line_no", "deck", "message")
    phases = R.phase_lines(_logs(m)).select("line_no", F.lit(None).cast("string").alias("deck"),
                                            F.concat("phase", F.lit(" @"), "at").alias("message"))
    return lines.unionByName(phases)


_KIND = """CASE WHEN contains(message, 'consistency=ok') THEN 'packaged' WHEN regexp_matches(message, '\\bESCALATED\\b') THEN 'escalated' WHEN regexp_matches(message, '\\bPARKED\\b') THEN 'parked'
 WHEN regexp_matches(message, '\\bCRASHED\\b') THEN 'crashed' WHEN regexp_matches(message, '\\bINFRA\\b|429|session limit|Too Many Requests') THEN 'infra' WHEN regexp_matches(message, '\\bFAILED\\b') THEN 'failed'
 WHEN regexp_matches(message, '\\bREJECTED\\b') THEN 'rejected' WHEN contains(message, 'repair CHANGED NOTHING') THEN 'no_op_repair' WHEN regexp_matches(message, '\\bBUSY\\b') THEN 'blocked'
 WHEN regexp_matches(message, '\\bTRUNCATED\\b') THEN 'truncated' WHEN regexp_matches(message, '\\brepaired \\(attempt') THEN 'repairing' WHEN starts_with(message, 'skipped —') THEN 'skipped' ELSE 'progress' END"""


@query("classify_lines", "R22", f"SELECT {_KIND} AS kind, count(*) AS n FROM log_lines GROUP BY 1")
def classify_lines(m):
    return m["log_lines"].groupBy(R.line_kind(F.col("message")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


_FOLD = f"""
fold AS (SELECT deck, arg_max({_KIND}, line_no) AS kind, arg_max(message, line_no) AS last, max(us) AS last_us, count(*) AS lines FROM log_lines GROUP BY deck),
comp AS (SELECT deck, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(message), '\\b[0-9a-f]{{8,}}\\b', '<hash>', 'g'), '\\b\\d+\\.\\d+\\b', '<num>', 'g'), '\\b\\d+\\b', '<n>', 'g'), '\\s+', ' ', 'g')) AS complaint, count(*) AS n
 FROM log_lines WHERE {_KIND} IN ('rejected', 'no_op_repair') GROUP BY 1, 2)
"""


@query("fold_deck_state", "R23", "WITH " + _FOLD + "SELECT fold.deck, kind, last, last_us, lines, coalesce((SELECT sum(n) FROM comp WHERE comp.deck = fold.deck), 0)::BIGINT AS complaints FROM fold")
def fold_deck_state(m):
    totals = R.complaints(m["log_lines"]).groupBy("deck").agg(F.sum("n").alias("complaints"))
    return R.fold_lines(m["log_lines"]).join(totals, "deck", "left").fillna(0, ["complaints"])


_NORM = "lower({c})"
for _p, _r in (("\\\\bdeck\\\\d+\\\\b", "<deck>"), ("\\\\bc\\\\d{{3,}}\\\\b", "<component>"), ("\\\\bd\\\\d+\\\\b", "<deg>"),
               ("\\\\bslides?\\\\s+[\\\\d,\\\\s and]+", "slide <n> "), ("@\\\\d+", "@<n>"), ("\\\\bp-\\\\d+\\\\b", "p-<n>"),
               ("\\\\b[0-9a-f]{{8,}}\\\\b", "<hash>"), ("\\\\b\\\\d+\\\\.\\\\d+\\\\b", "<num>"), ("\\\\b\\\\d+%", "<pct>"),
               ("\\\\b\\\\d+\\\\b", "<n>"), ("[/\\\\\\\\][\\\\w./\\\\\\\\-]+", "<path>"), ("\\\\s+", " ")):
    _NORM = "regexp_replace(" + _NORM + f", '{_p}', '{_r}', 'g')".replace("\\\\", "\\")
_NORM = "trim(" + _NORM + ")"
NORM_SQL = _NORM

_DIAG = "WITH " + _FOLD + """,
causes AS (SELECT """ + _NORM.format(c="last") + """ AS cause, deck FROM fold WHERE kind IN ('failed', 'rejected', 'parked')),
many AS (SELECT cause, count(DISTINCT deck) AS decks FROM causes GROUP BY cause HAVING count(DISTINCT deck) >= 2)
"""


@query("shared_causes", "R25", _DIAG + "SELECT cause, deck, decks FROM causes JOIN many USING (cause)")
def shared_causes(m):
    return R.shared_causes(R.fold_lines(m["log_lines"]))


@query("diagnose", "R24", _DIAG + """,
now AS (SELECT max(us) AS n FROM log_lines),
op AS (SELECT * FROM fold WHERE kind NOT IN ('packaged', 'parked', 'escalated', 'failed')),
named AS (SELECT c.deck, 'stop' AS level, 'same complaint ' || c.n || 'x: ' || complaint AS what FROM comp c JOIN op USING (deck) WHERE c.n >= 2
 UNION ALL SELECT deck, 'stop', 'escalated' FROM fold WHERE kind = 'escalated' UNION ALL SELECT deck, 'stop', 'waiting on a lock' FROM fold WHERE kind = 'blocked'
 UNION ALL SELECT deck, 'look', kind FROM fold WHERE kind IN ('crashed', 'infra')),
alerts AS (SELECT * FROM named UNION ALL SELECT deck, 'look', 'quiet ' || ((n - last_us) // 60000000) || 'm' FROM op, now WHERE (n - last_us) / 60000000.0 >= 25 AND deck NOT IN (SELECT deck FROM named)
 UNION ALL SELECT '', 'stop', decks || ' decks, one cause: ' || cause FROM many)
SELECT deck, level, what FROM alerts WHERE NOT (what = 'escalated' AND deck IN (SELECT 'deck' || lpad((user_id)::VARCHAR, 9, '0') FROM events WHERE user_id % 2 = 0))""")
def diagnose(m):
    states = R.fold_lines(m["log_lines"])
    now = m["log_lines"].agg(F.max("us").alias("now_us"))
    acked = m["log_lines"].where(F.col("uid") % 2 == 0).select("deck", F.lit("escalated").alias("what")).distinct()
    stamped = states.join(F.broadcast(now), how="cross")
    return R.diagnose(stamped, R.complaints(m["log_lines"]), F.col("now_us"), acked)


@query("supervision_report", "R26", "WITH " + _FOLD + "SELECT kind, count(*) AS decks, (SELECT max(us) FROM log_lines) // 60000000 AS newest_minutes_stamp, max(last_us) AS newest_us FROM fold GROUP BY kind")
def supervision_report(m):
    states = R.fold_lines(m["log_lines"])
    now = m["log_lines"].agg(F.max("us").alias("now_us"))
    rep = R.supervision_report(states, F.lit(0))
    newest = states.groupBy("kind").agg(F.max("last_us").alias("newest_us"))
    return rep.join(newest, "kind").join(F.broadcast(now), how="cross").select(
        "kind", "decks", F.expr("now_us div 60000000").alias("newest_minutes_stamp"), "newest_us")


_REASON = "CASE turn % 7 WHEN 0 THEN 'aborted_streaming' WHEN 1 THEN 'api_error' WHEN 2 THEN 'auth_error' WHEN 3 THEN 'max_turns' WHEN 4 THEN 'refusal' ELSE 'completed' END"


@query("session_outcome", "R27", f"""
WITH s AS (SELECT conv_id, turn, {_REASON} AS why, CASE WHEN conv_id % 3 = 0 THEN 403 ELSE 529 END AS api FROM sessions)
SELECT conv_id, turn, CASE WHEN why IN ('aborted_streaming', 'api_error', 'auth_error') THEN 'infra' WHEN why IN ('max_turns', 'refusal') THEN 'truncated' ELSE 'finished' END AS status,
 CASE WHEN why = 'api_error' AND api = 403 THEN 'auth_error' WHEN why <> 'completed' THEN why END AS kind FROM s""")
def session_outcome(m):
    rows = m["sessions"].withColumn("terminal_reason", F.expr(_REASON)).withColumn(
        "api_status", F.when(F.col("conv_id") % 3 == 0, 403).otherwise(529))
    return R.session_outcome(rows).select("conv_id", "turn", "status", "kind")


@query("model_that_worked", "R28", """
WITH u AS (SELECT session_id, 'model-' || (output % 4) AS model, sum(output)::BIGINT AS tokens FROM sessions GROUP BY 1, 2),
r AS (SELECT session_id, model FROM u QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY tokens DESC, model) = 1),
o AS (SELECT session_id, 'model-' || (min(conv_id) % 4) AS model_session FROM sessions GROUP BY 1)
SELECT o.session_id, model_session, r.model AS model_ran, r.model <> model_session AS fallback FROM o JOIN r USING (session_id)""")
def model_that_worked(m):
    s = m["sessions"]
    usage = s.groupBy("session_id", F.concat(F.lit("model-"), (F.col("output") % 4).cast("string")).alias("model")).agg(
        F.sum("output").alias("tokens")).withColumn("model_ord", F.col("model"))
    opened = s.groupBy("session_id").agg(F.concat(F.lit("model-"), (F.min("conv_id") % 4).cast("string")).alias("model_session"))
    return R.model_that_worked(usage, opened).select("session_id", "model_session", "model_ran", "fallback")


_CALL = """CASE turn % 4 WHEN 0 THEN 'Read' WHEN 1 THEN 'Write' WHEN 2 THEN 'Bash' ELSE 'Grep' END AS tool,
  concat('{"p": "/data/answers', CASE conv_id % 4 WHEN 0 THEN '/bundle/input.pptx' WHEN 1 THEN '/delta.json' WHEN 2 THEN '/solvability.json' ELSE '' END, ' /data/answers/plan.json"}') AS args"""


@query("access_audit", "R29", "WITH c AS (SELECT session_id, conv_id, turn, " + _CALL + """ FROM sessions),
h AS (SELECT session_id, tool, unnest(regexp_extract_all(args, '((?:/data/answers)(?:/[^\\s"'']*)?)', 1)) AS hit FROM c WHERE tool IN ('Read', 'Bash', 'Grep', 'Glob', 'NotebookRead'))
SELECT session_id, tool, hit, count(*) AS n FROM h WHERE NOT starts_with(hit, '/data/answers/bundle') AND NOT starts_with(hit, '/data/answers/solvability.json') GROUP BY ALL""")
def access_audit(m):
    calls = m["sessions"].selectExpr("session_id", *[x for x in _split_call()])
    return R.access_audit(calls, ["/data/answers"])


def _split_call():
    tool, args = _CALL.split(" AS tool,")
    return [tool + " AS tool", args.strip()]
