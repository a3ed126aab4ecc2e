"""Queries for record validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import validation as V
from gradeloom.plans.registry import query

_DEGS = """SELECT CAST(uid AS STRING) AS deck, concat('d', CAST(stage_idx AS STRING)) AS deg, stage, k % 25 AS slide, k AS est_steps, uid,
  CASE k % 5 WHEN 0 THEN 'relational' WHEN 1 THEN CASE WHEN uid % 3 = 0 THEN 'inductive' ELSE 'direct' END ELSE 'direct' END AS reasoning,
  CASE k % 7 WHEN 0 THEN 'compound' WHEN 1 THEN CASE WHEN uid % 4 = 0 THEN 'expert' ELSE 'basic' END ELSE 'basic' END AS interaction,
  CASE WHEN k % 11 = 0 THEN 'nowhere' WHEN k % 2 = 0 THEN 'on_slide' ELSE 'deck_wide' END AS reach, k, stage_idx FROM {src}"""
_DG = "dg AS (" + _DEGS.replace("{src}", "stage_state") + ")"
_TASKS = "SELECT CAST(uid AS STRING) AS deck, CASE WHEN uid % 19 = 0 THEN '' ELSE 'task' END AS name, 'do it' AS instruction, CASE WHEN uid % 6 = 0 THEN '' ELSE 'decoy' END AS distractor, 200 + uid % 40 AS est_steps, 20 AS n_slides FROM (SELECT DISTINCT uid FROM {src}) u"


def degs(m):
    return m.sql(_DEGS.replace("{src}", "{stage_state}"))


@query("proposal_findings", "V1", "WITH " + _DG + ", ts AS (" + _TASKS.replace("{src}", "stage_state") + """), pt AS (SELECT deck, sum(est_steps)::BIGINT AS parts, bool_or(reasoning = 'inductive') AS ind FROM dg GROUP BY deck), j AS (SELECT ts.*, parts, ind FROM ts LEFT JOIN pt USING (deck))
SELECT deck, name AS "key", 'missing name' AS "check" FROM j WHERE name = '' UNION ALL SELECT deck, name, 'no degradations' FROM j WHERE parts IS NULL UNION ALL SELECT deck, name, 'inductive without distractor' FROM j WHERE ind AND distractor = '' UNION ALL SELECT deck, name, 'headline and parts disagree' FROM j WHERE abs(parts - est_steps) > 0.25 * greatest(parts, est_steps)
UNION ALL SELECT deck, deg, 'page out of bounds' FROM dg WHERE slide < 1 OR slide > 20 UNION ALL SELECT deck, deg, 'unusable reach' FROM dg WHERE reach = 'nowhere'""")
def proposal_findings(m):
    return V.proposal_findings(m.sql(_TASKS.replace("{src}", "{stage_state}")), degs(m))


@query("difficulty_bands", "V2", "WITH " + _DG + ", p AS (SELECT deck, max(list_position(['direct','relational','inductive'], reasoning)) AS r, max(list_position(['basic','compound','expert'], interaction)) AS i, sum(est_steps)::BIGINT AS steps FROM dg GROUP BY deck) SELECT deck, CASE WHEN r = 3 OR i = 3 OR (r = 2 AND i = 2) THEN 'hard' WHEN r = 2 OR i = 2 THEN 'medium' ELSE 'easy' END AS band, CASE WHEN steps <= 100 THEN 'easy' WHEN steps <= 300 THEN 'medium' ELSE 'hard' END AS size_band, steps FROM p")
def difficulty_bands(m):
    return V.difficulty_bands(degs(m))


@query("disclosure_gaps", "V3", "SELECT DISTINCT deck, kind, slide, CASE WHEN kind IN ('picture', 'table') THEN 'derive' ELSE 'missing' END AS action FROM components WHERE (deck, kind, slide) NOT IN (SELECT (deck, kind, slide) FROM components WHERE rn % 3 = 0)")
def disclosure_gaps(m):
    need = m["components"].select("deck", "kind", "slide")
    return V.disclosure_gaps(need, m["components"].where("rn % 3 = 0").select("deck", "kind", "slide"), ["picture", "table"])


@query("recipe_findings", "V4", "WITH " + _DG + ", s AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'explode' WHEN k % 2 = 0 THEN 'move' ELSE 'delete' END AS op FROM dg WHERE k % 9 <> 0), dc AS (SELECT deck, deg FROM dg WHERE k % 8 <> 0) SELECT DISTINCT deck, op AS \"key\", 'unknown operation' AS \"check\" FROM s WHERE op = 'explode' UNION ALL SELECT DISTINCT deck, op, 'page out of bounds' FROM s WHERE slide >= 20 UNION ALL SELECT DISTINCT deck, deg, 'step names an undeclared degradation' FROM s WHERE (deck, deg) NOT IN (SELECT (deck, deg) FROM dc) UNION ALL SELECT deck, deg, 'degradation without steps' FROM dc WHERE (deck, deg) NOT IN (SELECT (deck, deg) FROM s)")
def recipe_findings(m):
    d = degs(m)
    steps = d.where("k % 9 <> 0").select("deck", "deg", "slide", F.expr("CASE WHEN k % 13 = 0 THEN 'explode' WHEN k % 2 = 0 THEN 'move' ELSE 'delete' END").alias("op"), F.lit(20).alias("n_slides"))
    ops = m["components"].select("op").distinct()
    return V.recipe_findings(steps, ops, d.where("k % 8 <> 0").select("deck", "deg"))


@query("focused_findings", "V5", "WITH " + _DG + ", s AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'strip_effects' ELSE 'chart_edit' END AS op, CASE WHEN uid % 2 = 0 THEN 'chart_edit' ELSE 'strip_effects' END AS want FROM dg) SELECT deck, deg AS \"key\", 'operation outside the family' AS \"check\" FROM s WHERE op <> want")
def focused_findings(m):
    d = degs(m)
    steps = d.select("deck", "deg", F.when(F.col("k") % 4 == 0, "strip_effects").otherwise("chart_edit").alias("op"))
    focus = d.select("deck", F.when(F.col("uid") % 2 == 0, "chart").otherwise("effects").alias("family")).distinct()
    return V.focused_findings(steps, focus)


@query("reconcile_findings", "V6", "WITH r AS (SELECT DISTINCT uid::VARCHAR AS deck, uid, CASE WHEN uid % 11 = 0 THEN '' WHEN uid % 5 = 0 THEN 'needs_rework' ELSE 'ready' END AS verdict, CASE WHEN uid % 2 = 0 THEN 'Asset LOGO.png is missing' ELSE '' END AS note FROM stage_state) SELECT deck, deck AS \"key\", 'no verdict' AS \"check\" FROM r WHERE verdict = '' UNION ALL SELECT deck, deck, 'rework without a reason' FROM r WHERE verdict = 'needs_rework' AND note = '' UNION ALL SELECT deck, 'logo.png', 'unmet asset not mentioned' FROM r WHERE uid % 3 = 0 AND note = ''")
def reconcile_findings(m):
    r = m["stage_state"].select(F.col("uid").cast("string").alias("deck"), "uid").distinct().selectExpr(
        "deck", "uid", "CASE WHEN uid % 11 = 0 THEN '' WHEN uid % 5 = 0 THEN 'needs_rework' ELSE 'ready' END AS verdict", "CASE WHEN uid % 2 = 0 THEN 'Asset LOGO.png is missing' ELSE '' END AS note")
    return V.reconcile_findings(r, r.where("uid % 3 = 0").select("deck", F.lit("logo.png").alias("name")))


_ITEMS = "SELECT deck, deg, k - 2 AS steps, k % 3 <> 0 AS determinate, CASE WHEN k % 10 = 1 THEN 2 ELSE 0 END AS rivals, k % 14 = 2 AS overdetermined, CASE WHEN k % 6 = 0 THEN ' ' ELSE 'seen' END AS evidence, uid FROM {src}"
_REPORT = "SELECT DISTINCT deck, CAST(100 + uid % 150 AS BIGINT) AS total, CASE WHEN uid % 13 = 0 THEN 1 ELSE 0 END AS leaks, CASE WHEN uid % 4 = 0 THEN 'off' ELSE 'ok' END AS band, CASE WHEN uid % 8 = 0 THEN '' ELSE 'why' END AS note FROM {src}"


@query("rubric_findings", "V7", "WITH " + _DG + ", it AS (" + _ITEMS.replace("{src}", "dg") + "), rp AS (" + _REPORT.replace("{src}", "dg") + "), sm AS (SELECT deck, sum(steps)::BIGINT AS s FROM it GROUP BY deck) SELECT deck, deg AS \"key\", 'steps missing' AS \"check\" FROM it WHERE steps <= 0 UNION ALL SELECT deck, deg, 'rivals on a determinate item' FROM it WHERE determinate AND rivals > 0 UNION ALL SELECT deck, deg, 'evidence missing' FROM it WHERE evidence = ' ' UNION ALL SELECT deck, deck, 'steps do not add up' FROM rp JOIN sm USING (deck) WHERE abs(s - total) > 0.25 * total UNION ALL SELECT deck, deck, 'band without a note' FROM rp WHERE band = 'off' AND note = ''")
def rubric_findings(m):
    d = degs(m)
    return V.rubric_findings(m.sql(_REPORT, src=d), m.sql(_ITEMS, src=d))


@query("probe_verdicts", "V8", "WITH " + _DG + ", it AS (" + _ITEMS.replace("{src}", "dg") + "), rp AS (" + _REPORT.replace("{src}", "dg") + "), w AS (SELECT deck, min(CASE WHEN NOT determinate AND rivals = 0 THEN 2 WHEN rivals > 0 THEN 3 WHEN overdetermined THEN 4 ELSE 5 END) AS r FROM it GROUP BY deck), f AS (SELECT deck, CASE WHEN leaks > 0 THEN 1 ELSE coalesce(r, 5) END::BIGINT AS rule FROM rp LEFT JOIN w USING (deck)) SELECT deck, rule, ['leaked', 'undetermined', 'ambiguous', 'overdetermined', 'solvable'][rule] AS verdict FROM f")
def probe_verdicts(m):
    d = degs(m)
    return V.verdicts(m.sql(_REPORT, src=d), m.sql(_ITEMS, src=d))


@query("provenance_findings", "V11", "WITH i AS (SELECT deck, stage || '/' || input AS input, digest_then AS was, digest_now AS now FROM stage_inputs), r AS (SELECT DISTINCT deck, uid FROM stage_state) SELECT deck, deck AS \"key\", 'record of another deck' AS \"check\" FROM r WHERE uid % 21 = 0 UNION ALL SELECT deck, deck, 'upstream was refused' FROM r WHERE uid % 6 = 1 UNION ALL SELECT deck, input, 'input changed' FROM i WHERE was IS DISTINCT FROM now AND input NOT IN ('scored/<code>', 'packaged/a.json')")
def provenance_findings(m):
    i = m["stage_inputs"].withColumn("input", F.concat_ws("/", "stage", "input"))
    records = m["stage_state"].select("deck", "uid").distinct().select(
        "deck", F.when(F.col("uid") % 21 == 0, "deckX").otherwise(F.col("deck")).alias("recorded_deck"), (F.col("uid") % 6 == 1).alias("refused"))
    then = i.where(F.col("digest_then").isNotNull()).select("deck", "input", F.col("digest_then").alias("digest"))
    return V.provenance_findings(then, i.select("deck", "input", F.col("digest_now").alias("digest")), records, ["scored/<code>", "packaged/a.json"])


@query("run_findings", "V12", "WITH s AS (SELECT DISTINCT deck, uid FROM stage_state WHERE stage = 'packaged' AND status = 'ok') SELECT deck, 'plan.json' AS \"key\", 'required file missing' AS \"check\" FROM s WHERE uid % 3 = 0 UNION ALL SELECT deck, deck, 'publication unconfirmed' FROM s WHERE uid % 5 = 0")
def run_findings(m):
    s = m["stage_state"].where("stage = 'packaged' AND status = 'ok'").select("deck", "uid").distinct()
    files = s.select("deck", F.explode(F.expr("CASE WHEN uid % 3 = 0 THEN array('task.json', 'input.pptx') ELSE array('task.json', 'input.pptx', 'plan.json') END")).alias("name"))
    return V.run_findings(s, files, s.where("uid % 5 <> 0"))
