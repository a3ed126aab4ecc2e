"""Queries for plans, gates, scope penalties and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.operators import damage as D
from gradeloom.operators import matching as M
from gradeloom.operators import scoring as P
from gradeloom.operators.graded import STEP_FIELDS, Facts
from gradeloom.plans.comparing import _CENTRE, _FILL, _NODES, COLS, restored_sql, theme
from gradeloom.plans.models import MODELS, SLIDE_H, SLIDE_W
from gradeloom.plans.pairing_sql import pairs_sql
from gradeloom.plans.registry import query
from gradeloom.session import cut_lineage, put_down

_NUM = "nm AS (SELECT *, 'c' || lpad(row_number() OVER (PARTITION BY deck ORDER BY slide, rn, op)::VARCHAR, 6, '0') AS id FROM components)"
_DEGS = """SELECT deck, deg, est_steps, CASE WHEN pick % 4 = 0 THEN NULL ELSE measured END AS measured FROM (
  SELECT deck, deg, sum(est_steps) AS est_steps, sum(measured) AS measured, CAST(right(deck, 2) AS BIGINT) AS pick FROM {src} GROUP BY deck, deg) g WHERE NOT (pick % 5 = 0 AND deg = 'd5')
  UNION ALL SELECT DISTINCT deck, 'd9' AS deg, CAST(0 AS BIGINT) AS est_steps, CAST(NULL AS BIGINT) AS measured FROM {src} WHERE CAST(right(deck, 2) AS BIGINT) % 6 = 0"""
_DG = "dg AS (SELECT deck, deg, est_steps::BIGINT AS est_steps, measured::BIGINT AS measured FROM (" + _DEGS.replace("{src}", "components") + "))"


def numbered(m):
    return P.number_components(m["components"])


def degradations(m):
    return m.sql(_DEGS.replace("{src}", "{components}"))


@query("plan_components", "P1", "WITH " + _NUM + "SELECT deck, id, slide, gt_path, op, deg FROM nm")
def plan_components(m):
    return numbered(m).select("deck", "id", "slide", "gt_path", "op", "deg")


@query("damage_regions", "P2", "SELECT DISTINCT deck, slide, gt_path AS path, cx, cy, w, h FROM components")
def damage_regions(m):
    return P.damage_regions(m["components"])


@query("traceability", "P4", "WITH " + _DG + """, nd AS (SELECT DISTINCT deck, CASE WHEN rn % 31 = 0 THEN NULL ELSE deg END AS deg FROM components), dd AS (SELECT DISTINCT deck, deg FROM dg)
SELECT deck, 'component without degradation' AS "check", deg AS "key" FROM nd WHERE deg IS NULL UNION ALL SELECT deck, 'unknown degradation', deg FROM nd WHERE deg IS NOT NULL AND (deck, deg) NOT IN (SELECT (deck, deg) FROM dd)
UNION ALL SELECT deck, 'degradation with no component', deg FROM dd WHERE (deck, deg) NOT IN (SELECT (deck, deg) FROM nd WHERE deg IS NOT NULL) UNION ALL SELECT deck, 'no step estimate', deg FROM dg WHERE est_steps <= 0""")
def traceability(m):
    m.keep("components")
    comps = m["components"].withColumn("deg", F.when(F.col("rn") % 31 == 0, F.lit(None)).otherwise(F.col("deg")))
    return P.traceability(comps, degradations(m))


_NOTES = "nt AS (SELECT deck, deg, measured, deg || CASE WHEN measured % 3 = 0 THEN ' rebuild on slide 12 ~' || measured WHEN measured % 3 = 1 THEN ' about ' || measured ELSE ' takes roughly ' || measured END AS text FROM dg WHERE measured IS NOT NULL)"


@query("measured_steps", "P5", "WITH " + _DG + """,
pr AS (SELECT deck, deg, est_steps + 1 AS prose FROM dg WHERE deg <> 'd4' OR right(deck, 1) <> '8'), tt AS (SELECT deck, sum(est_steps) * CASE WHEN right(deck, 1) = '4' THEN 2 ELSE 1 END AS total FROM dg GROUP BY deck),
j AS (SELECT dg.deck, dg.deg, measured, prose FROM dg LEFT JOIN pr USING (deck, deg)), fl AS (SELECT deck, bool_and(measured IS NOT NULL) AS s, bool_and(prose IS NOT NULL) AS p FROM j GROUP BY deck),
f AS (SELECT j.deck, deg, s, p, CASE WHEN s THEN measured WHEN p THEN prose ELSE coalesce(measured, prose) END AS figure FROM j JOIN fl USING (deck)), sm AS (SELECT deck, sum(figure) AS sm FROM f GROUP BY deck)
SELECT f.deck, deg, figure AS measured, (s OR p) AND coalesce(abs(sm - total) / nullif(total, 0) <= 0.25, false) AS usable FROM f JOIN sm USING (deck) JOIN tt USING (deck)""")
def measured_steps(m):
    degs = degradations(m)
    said = degs.where((F.col("deg") != "d4") | (F.right("deck", F.lit(1)) != "8"))
    text = F.concat(F.col("deg"), F.when(F.col("est_steps") % 3 == 0, " rebuild, ~").when(F.col("est_steps") % 3 == 1, " is about ").otherwise(" takes roughly "), (F.col("est_steps") + 1).cast("string"))
    totals = degs.groupBy("deck").agg((F.sum("est_steps") * F.max(F.when(F.right("deck", F.lit(1)) == "4", 2).otherwise(1))).alias("total"))
    return P.measured_steps(said.select("deck", text.alias("text")), degs, totals)


@query("step_disagreement", "P6", "WITH " + _DG + "SELECT deck, max(round_even(greatest(est_steps, measured) / least(est_steps, measured)::DOUBLE, 3)) FILTER (WHERE est_steps > 0 AND measured > 0)::DOUBLE AS worst, NOT bool_or(right(deck, 1) IN ('1', '2')) AND max(round_even(greatest(est_steps, measured) / least(est_steps, measured)::DOUBLE, 3)) FILTER (WHERE est_steps > 0 AND measured > 0) > 3.0 AS refused FROM dg GROUP BY deck")
def step_disagreement(m):
    degs = degradations(m).withColumn("usable", F.right("deck", F.lit(1)).isin("1", "2"))
    return P.step_disagreement(degs)


_WEIGHTS = "wt AS (" + """SELECT nm.deck, nm.id, nm.slide, nm.gt_path, nm.op, nm.deg, sc FROM (SELECT *, rn % 7 <> 3 AS sc FROM nm) nm),
al AS (SELECT deck, deg, count(*) AS n_all, count(*) FILTER (WHERE sc) AS n_sc FROM wt GROUP BY ALL),
sh AS (SELECT wt.deck, wt.id, wt.deg, est_steps, est_steps * (n_sc / n_all) / n_sc AS s, min(CASE WHEN est_steps > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY wt.deck) AS kn FROM wt JOIN al USING (deck, deg) LEFT JOIN dg USING (deck, deg) WHERE sc),
ws AS (SELECT deck, id, deg, CASE WHEN kn = 1 THEN s ELSE 1.0 END AS w, kn FROM sh)"""


@query("component_weights", "P7", "WITH " + _NUM + "," + _DG + "," + _WEIGHTS + " SELECT deck, id, round(w / sum(w) OVER (PARTITION BY deck), 9) AS weight, CASE WHEN kn = 1 THEN 'steps' ELSE 'equal' END AS weight_source FROM ws")
def component_weights(m):
    comps = numbered(m).withColumn("scoreable", F.col("rn") % 7 != 3).drop("est_steps", "measured")
    degs = degradations(m).withColumn("steps", F.col("est_steps"))
    return P.component_weights(comps, degs).select("deck", "id", F.round("weight", 9).alias("weight"), "weight_source")


@query("declaration_split", "P8", "WITH " + _DG + ", t AS (SELECT deck, sum(est_steps)::BIGINT AS parts FROM dg GROUP BY deck) SELECT deck, parts + right(deck, 2)::BIGINT * 10 AS est_total, parts, (right(deck, 2)::BIGINT * 10) / nullif(parts + right(deck, 2)::BIGINT * 10, 0) > 0.25 AS refused FROM t")
def declaration_split(m):
    degs = degradations(m)
    tasks = degs.groupBy("deck").agg((F.sum("est_steps") + F.right(F.first("deck"), F.lit(2)).cast("long") * 10).alias("est_total"))
    return P.declaration_split(tasks, degs)


@query("duplicate_components", "P10", "WITH " + _NUM + ", d AS (SELECT *, gt_path AS p2 FROM nm UNION ALL SELECT * REPLACE (id || 'x' AS id), gt_path FROM nm WHERE rn % 13 = 0), f AS (SELECT deck, op, slide, gt_path, deg, min(id) AS first_id, count(*) AS n FROM d GROUP BY ALL) SELECT d.deck, d.id, first_id FROM d JOIN f USING (deck, op, slide, gt_path, deg) WHERE n > 1 AND d.id <> first_id")
def duplicate_components(m):
    nm = numbered(m)
    twice = nm.unionByName(nm.where(F.col("rn") % 13 == 0).withColumn("id", F.concat("id", F.lit("x"))))
    return P.duplicate_components(twice, ["deg"])


# ------------------------------------------------------------------ scoring one pass of four scenarios

def _supplied(m):
    """Assets handed over: every picture of the answer except in some decks."""
    return m["shapes_gt"].where(F.col("blob").isNotNull() & (F.col("deckno") % 5 != 0)).select("deck", F.col("blob").alias("sha")).distinct()


def weighted(m):
    n = numbered(m).drop("est_steps", "measured").withColumn("scoreable", F.lit(True))
    degs = m["components"].groupBy("deck", "deg").agg(F.sum("est_steps").alias("steps"))
    return P.component_weights(n, degs)


#: The operations of the model's components.
MODEL_OPS = ("delete", "move", "recolor")


#: The scenarios of the model's frames.
FRAMED = ("gt", "noop", "candidate", "tricks")


def _frame_rows(m, whole, rest, names):
    """Child rows of the named scenarios: whole in the answer, as in the candidate everywhere else."""
    others = F.explode(F.array(*[F.lit(n) for n in names if n != "gt"]))
    return whole, whole.withColumn("scenario", F.lit("gt")).unionByName(rest.withColumn("scenario", others))


def frame_facts(m, names):
    """Cells and series of every scenario, so that a table or chart put back is judged by what it holds."""
    cells, points = ["deck", "slide", "path", "r", "c", "text"], ["deck", "slide", "path", "sno", "sname", "i", "val", "category"]
    none = m.spark.createDataFrame([], "deck string, id string, what string, i long, j long, t string, u string")
    return Facts(none, cells=_frame_rows(m, m["cells"].select(*cells), m["cells_candidate"].select(*cells), names),
                 series=_frame_rows(m, m["series"].select(*points), m["series_candidate"].select(*points), names))


def scoring(m, frames=None, names=FRAMED):
    """One scoring pass over the scenarios ``names``; the answer's shapes, from which all frames are told, are written once."""
    if frames is None:
        m.keep("shapes_gt")
    m.unpacked()
    return P.Scoring(m["shapes_gt"], m["shapes_input"], m["frames"] if frames is None else frames, put_down(weighted(m)), _supplied(m), SLIDE_W, SLIDE_H, theme(m), MODEL_OPS, frame_facts(m, names))


#: Row operations that a recipe applies: place on the page, whether it applies, parameters.
_RECIPE = {"move": (0, "true", {"dx_in": 0.5, "dy_in": 0.0}), "resize": (1, "true", {"factor": 1.5, "keep_centre": True}), "rotate": (2, "true", {"angle": "'45'"}),
           "recolor": (3, "fill_type IS NOT NULL", {"color": "'srgb:FF00FF'"}), "outline": (4, "true", {"color": "'srgb:00FF01'", "width": "CAST(99999 AS BIGINT)"}),
           "strip_effects": (5, "effects IS NOT NULL", {}), "clear_text": (6, "plain <> ''", {"keep_first": False}), "set_text": (7, "plain <> ''", {"text": "'zzz'"}),
           "set_font": (8, "true", {"new_font": "'Wingdings'", "new_sz": "CAST(NULL AS BIGINT)", "new_bold": "CAST(NULL AS BOOLEAN)"})}
#: The components of every operation, and of one that nobody knows; ``top`` is the page's last shape.
_PLACES = {**{op: f"rn % 20 = {k} AND {cond}" for op, (k, cond, _) in _RECIPE.items()},
           "delete": "rn % 20 = 9", "blank_slide": "rn % 20 = 14", "scatter": "rn % 20 = 11", "swap": "rn % 20 = 12", "drop_equation": "rn % 20 = 13",
           "crop": "rn % 20 = 15 AND blob IS NOT NULL", "detach_connector": "rn % 20 = 16 AND kind = 'connector'", "zorder": "rn = 17 AND top >= 18",
           "ungroup": "rn = 10 AND top >= 11", "teleport": "rn % 20 = 18", "clear_table_cells": "kind = 'table' AND rn % 3 = 0",
           "table_drop_rows": "kind = 'table' AND rn % 3 = 1", "table_drop_cols": "kind = 'table' AND rn % 3 = 2", "smartart_drop_nodes": "kind = 'smartart'",
           "chart_edit": "kind = 'chart' AND rn % 2 = 0", "text_runs": "kind = 'textbox'", "strip_animation": "rn = 0 AND slide % 5 = 0",
           "anim_drop_steps": "rn = 0 AND slide % 5 = 1 AND top >= 3", "strip_transition": "rn = 0 AND slide % 5 = 2", "clear_notes": "rn = 0 AND slide % 5 = 3",
           "reorder_slides": "rn = 0 AND slide = 4 AND deckno % 3 = 0", "delete_slides": "rn = 0 AND slide = 12 AND deckno % 3 = 1", "layout_edit": "rn = 0 AND slide = 0"}
_PLACED = " UNION ALL ".join(f"SELECT deck, slide, path, deckno, '{op}' AS op FROM {{src}} WHERE {cond}" for op, cond in _PLACES.items())
_TOPPED = "SELECT g.*, max(rn) OVER (PARTITION BY deck, slide) AS top FROM {src} g"


def _three(gt, noop):
    """The answer, the damaged rows, and a half-way state in which the even decks are whole again."""
    even = F.substring("deck", -1, 1).cast("int") % 2 == 0
    named = ((gt, "gt"), (noop, "noop"), (gt.where(even).unionByName(noop.where(~even)), "half"))
    out = None
    for rows, name in named:
        rows = rows.withColumn("scenario", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return gt, out


def _graded_facts(m, shapes):
    """Child tables of all operations, damaged where a component stands."""
    def model(name):
        return m.sql(MODELS[name], shapes_gt=shapes)

    own = shapes.select("deck", "slide", "path", "rn")
    pos = F.col("rn") % 3
    cells = model("cells").select("deck", "slide", "path", "r", "c", "text").join(own, ["deck", "slide", "path"])
    row, col = F.col("r"), F.col("c")
    less = (cells.withColumn("text", F.when((pos == 0) & (row == 1), "").otherwise(F.col("text")))
            .where(~((pos == 1) & (row == 2)) & ~((pos == 2) & (col == 1)))
            .withColumn("r", row - F.when((pos == 1) & (row > 2), 1).otherwise(0)).withColumn("c", col - F.when((pos == 2) & (col > 1), 1).otherwise(0)))
    nodes = m.sql(_NODES.replace("{src}", "{shapes_gt}"), shapes_gt=shapes).select("deck", "slide", "path", "t", "i")
    charts = shapes.where("kind = 'chart'").select("deck", "slide", "path", F.lit("title").alias("element"), F.concat(F.lit("T"), "pk").alias("value"))
    boxes = shapes.where("kind = 'textbox'").select("deck", "slide", "path", "pk")
    runs = (boxes.withColumn("para", F.explode(F.sequence(F.lit(0), F.lit(1)))).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(1))))
            .select("deck", "slide", "path", F.col("para").cast("long").alias("para"), F.col("run").cast("long").alias("run"),
                    F.concat_ws("-", "para", "run", "pk").alias("t"), F.lit("Arial").alias("font"), F.lit(12).cast("long").alias("sz")))
    effects = model("anim_effects").select("deck", "slide", "step", *STEP_FIELDS)
    step = F.col("step")
    fewer = (effects.where((F.col("slide") % 5 != 0) & ~((F.col("slide") % 5 == 1) & (step == 1)))
             .withColumn("step", step - F.when((F.col("slide") % 5 == 1) & (step > 1), 1).otherwise(0)))
    pages = shapes.select("deck", "slide").distinct().select("deck", "slide", F.concat_ws(" ", F.lit("note"), "deck", "slide").alias("notes"), F.lit("fade:left").alias("transition"))
    bare = pages.withColumn("transition", F.when(F.col("slide") % 5 != 2, F.col("transition"))).withColumn("notes", F.when(F.col("slide") % 5 != 3, F.col("notes")))
    marks = shapes.select("deck", "deckno", "slide", "path", F.concat_ws("-", "slide", F.col("rn") % 4).alias("plain"))
    slide, third = F.col("slide"), F.col("deckno") % 3
    moved = (marks.where(~((third == 1) & (slide == 12)))
             .withColumn("slide", F.when((third == 0) & (slide == 4), 7).when((third == 0) & (slide == 7), 4).when((third == 1) & (slide > 12), slide - 1).otherwise(slide).cast("long")))
    layouts = M.with_keys(shapes.where("slide < 2").withColumn("layout", F.when(slide == 0, "Title").otherwise("Body")))
    nil, text = F.lit(None).cast("long"), F.lit(None).cast("string")

    def detail(op, rows, what, i=nil, j=nil, t=text, u=text):
        ident = F.concat_ws("/", F.lit(op), "slide", "path")
        return rows.select("deck", ident.alias("id"), F.lit(what).alias("what"), i.cast("long").alias("i"), j.cast("long").alias("j"), t.alias("t"), u.alias("u"))

    first = shapes.where("rn = 0")
    details = [
        detail("clear_table_cells", cells.where((pos == 0) & (row == 1) & (F.col("text") != "")), "cell", row, col),
        detail("table_drop_rows", own, "row", F.lit(2)), detail("table_drop_cols", own, "col", F.lit(1)),
        detail("smartart_drop_nodes", nodes.where("i < 2"), "node", t=F.col("t")),
        detail("chart_edit", charts, "series", t=F.lit("S1")), detail("chart_edit", charts, "element", t=F.lit("title")),
        detail("text_runs", boxes, "paragraph", F.lit(0), t=F.lit("deleted")), detail("text_runs", boxes, "paragraph", F.lit(1), t=F.lit("restyled")),
        detail("anim_drop_steps", first, "step", F.lit(1)), detail("reorder_slides", first.where("slide = 4"), "swap", F.lit(4), F.lit(7)),
        detail("delete_slides", first.where("slide = 12"), "cut", F.lit(12)),
        detail("layout_edit", first.where("slide = 0").join(layouts.where("layout = 'Title' AND rn % 10 IN (3, 4)").select("deck", F.col("path").alias("gone")), "deck"),
               "layout", t=F.lit("Title"), u=F.col("gone")),
    ]
    styled = runs.where("para = 1").withColumn("font", F.lit("Comic"))
    series = model("series").select("deck", "slide", "path", "sno", "sname", "i", "val", "category")
    return Facts(
        cut_lineage(reduce(DataFrame.unionByName, details)), cells=_three(cells.drop("rn"), less.drop("rn")), series=_three(series, series.where("sname <> 'S1'")),
        elements=_three(charts, charts.limit(0)), nodes=_three(nodes.drop("i"), nodes.where("i >= 2").drop("i")), runs=_three(runs, styled),
        effects=_three(effects, fewer), pages=_three(pages, bare), shapes=_three(marks.drop("deckno"), moved.drop("deckno")),
        layouts=_three(layouts, layouts.where("NOT (layout = 'Title' AND rn % 10 IN (3, 4))")))


@query("operation_scores", "P3 P9 P12", f"""WITH s AS ({_TOPPED.replace("{src}", "shapes_gt")}), c AS ({_PLACED.replace("{src}", "s")})
SELECT op, x.scenario, count(*) AS n, count(*) FILTER (WHERE op <> 'teleport' AND (x.scenario = 'gt' OR (x.scenario = 'half' AND deckno % 2 = 0))) AS full_marks,
 count(*) FILTER (WHERE op <> 'teleport' AND (x.scenario = 'noop' OR (x.scenario = 'half' AND deckno % 2 = 1))) AS nothing, count(*) FILTER (WHERE op = 'teleport') AS unscored
FROM c CROSS JOIN (VALUES ('gt'), ('noop'), ('half')) x(scenario) GROUP BY op, x.scenario""")
def operation_scores(m):
    """All operations damage their share of all decks: the answer earns all of it, the damaged file nothing, an unknown operation stays unscored."""
    shapes = cut_lineage(m["shapes_gt"])
    steps = None
    for op, (k, cond, params) in _RECIPE.items():
        own = shapes.where(f"rn % 20 = {k} AND {cond}").select(
            "deck", "slide", "path", F.lit("d1").alias("deg"), F.lit(op).alias("op"), *[(F.expr(v) if isinstance(v, str) else F.lit(v)).alias(c) for c, v in params.items()])
        steps = own if steps is None else steps.unionByName(own, allowMissingColumns=True)
    at = F.col("rn") % 20

    def equations(df, native):
        return df.withColumns({"eq_structure": F.when(at == 13, "frac"), "eq_text": F.when(at == 13, "x"), "eq_native": native})

    gt = equations(shapes, F.lit(True))
    broken = equations(D.apply_recipe(shapes, steps)[0], at != 13).where(~at.isin(9, 14) & (F.col("rn") != 10)).withColumns({
        "cx": F.col("cx") + F.when(at == 11, 700000).when(at == 12, 500000).otherwise(0),
        "crop": F.when(at == 15, "l:99").otherwise(F.col("crop")), "start_id": F.when(at != 16, F.col("start_id")), "end_id": F.when(at != 16, F.col("end_id")),
        "z": F.col("z") + F.when(F.col("rn") == 17, 100000).otherwise(0), "grp": F.when(F.col("grp") != "10", F.col("grp"))})
    cols = [c for c in gt.columns if c not in ("deck", "slide")]
    frames = _three(gt, broken.select(*gt.columns))[1]
    left = gt.select("deck", "slide", *[F.col(c).alias(f"a_{c}") for c in cols]).join(F.broadcast(frames.select("scenario").distinct()), how="cross")
    right = frames.select("scenario", "deck", "slide", F.col("path").alias("a_path"), *[F.col(c).alias(f"b_{c}") for c in cols])
    wide = left.join(right, ["scenario", "deck", "slide", "a_path"], "left").withColumns({"theme": F.lit(None).cast("map<string,string>"), "strong": F.lit(True)})
    wide = cut_lineage(wide)
    here = F.array_compact(F.array(*[F.when(F.expr(cond), op) for op, cond in _PLACES.items()]))
    comps = cut_lineage(m.sql(_TOPPED.replace("{src}", "{shapes}"), shapes=shapes).select("deck", "slide", "path", F.explode(here).alias("op")).select(
        "deck", "slide", F.col("path").alias("gt_path"), F.concat_ws("/", "op", "slide", "path").alias("id"), "op", F.when(F.col("op") == "zorder", "front").alias("to")))
    facts = _graded_facts(m, shapes)
    scores = P.normalise_by_floor(P.component_raw(comps, wide, P.content_scores(facts, wide), facts=facts, depth=3), "noop")
    return scores.groupBy("op", "scenario").agg(
        F.count("*").alias("n"), F.count_if(F.col("score") > 1 - 1e-9).alias("full_marks"),
        F.count_if(F.col("raw").isNotNull() & (F.col("score") < 1e-9)).alias("nothing"), F.count_if(F.col("raw").isNull()).alias("unscored"))


_COLS = ", ".join(f"g.{c} AS a_{c}, o.{c} AS b_{c}" for c in COLS if c != "crop")
SQL_SCENE = pairs_sql("frames", scenario=True) + f""",
sn AS (SELECT unnest(['gt', 'noop', 'candidate', 'tricks']) AS scenario),
wd AS MATERIALIZED (SELECT sn.scenario AS scenario, g.deck AS deck, g.slide AS slide, g.path AS a_path, o.path AS b_path, coalesce(NOT (pr.key LIKE 'name:%' OR pr.key LIKE 'geo:%' OR pr.key LIKE 'kind:%'), false) AS strong, {_COLS}
 FROM shapes_gt g CROSS JOIN sn LEFT JOIN pr ON pr.scenario = sn.scenario AND pr.deck = g.deck AND pr.slide = g.slide AND pr.gp = g.path LEFT JOIN frames o ON o.scenario = sn.scenario AND o.deck = g.deck AND o.slide = g.slide AND o.path = pr.op),
lo AS MATERIALIZED (SELECT * FROM frames f WHERE NOT EXISTS (SELECT 1 FROM pr WHERE pr.scenario = f.scenario AND pr.deck = f.deck AND pr.slide = f.slide AND pr.op = f.path)),
dp AS (SELECT DISTINCT deck, slide FROM components), rg AS (SELECT DISTINCT deck, slide, gt_path AS path, cx, cy, w, h FROM components)
"""
_SHAPE = "scenario, deck, slide, path"
#: Tables and charts of every scenario against the answer's, through the pairing; ends in ``tab`` and ``cht``.
SQL_CONTENT = f"""
cp AS MATERIALIZED (SELECT scenario, deck, slide, a_path AS path, b_path, a_kind FROM wd WHERE a_kind IN ('table', 'chart')),
cw AS MATERIALIZED (SELECT {_SHAPE}, r, c, text FROM cp JOIN cells USING (deck, slide, path) WHERE a_kind = 'table'),
fc AS (SELECT 'gt' AS scenario, deck, slide, path, r, c, text FROM cells UNION ALL SELECT scenario, deck, slide, path, r, c, text FROM cells_candidate CROSS JOIN sn WHERE scenario <> 'gt'),
ch AS MATERIALIZED (SELECT cp.scenario, cp.deck, cp.slide, cp.path, r, c, text FROM cp JOIN fc ON fc.scenario = cp.scenario AND fc.deck = cp.deck AND fc.slide = cp.slide AND fc.path = cp.b_path WHERE a_kind = 'table'),
tw AS (SELECT {_SHAPE}, max(r) AS mr, max(c) AS mc FROM cw GROUP BY ALL), th AS (SELECT {_SHAPE}, max(r) AS mr, max(c) AS mc FROM ch GROUP BY ALL),
tc AS (SELECT {", ".join("cw." + c for c in _SHAPE.split(", "))}, count(*) AS n, count(*) FILTER (WHERE ch.text = cw.text) AS hit FROM cw LEFT JOIN ch USING ({_SHAPE}, r, c) WHERE cw.text <> '' GROUP BY ALL),
tab AS (SELECT {_SHAPE}, CASE WHEN tw.mr = th.mr AND tw.mc = th.mc THEN coalesce(hit / n, 0) ELSE 0 END::DOUBLE AS raw FROM tw LEFT JOIN th USING ({_SHAPE}) LEFT JOIN tc USING ({_SHAPE})),
pw AS MATERIALIZED (SELECT {_SHAPE}, sname, i, val, category FROM cp JOIN series USING (deck, slide, path) WHERE a_kind = 'chart'),
fp AS (SELECT 'gt' AS scenario, deck, slide, path, sname, i, val, category FROM series UNION ALL SELECT scenario, deck, slide, path, sname, i, val, category FROM series_candidate CROSS JOIN sn WHERE scenario <> 'gt'),
ph AS MATERIALIZED (SELECT cp.scenario, cp.deck, cp.slide, cp.path, sname, i, val, category FROM cp JOIN fp ON fp.scenario = cp.scenario AND fp.deck = cp.deck AND fp.slide = cp.slide AND fp.path = cp.b_path WHERE a_kind = 'chart'),
sw AS (SELECT {_SHAPE}, sname, count(*) AS n FROM pw GROUP BY ALL), sh AS (SELECT {_SHAPE}, sname, count(*) AS n FROM ph GROUP BY ALL),
sv AS (SELECT {_SHAPE}, sname, count(*) FILTER (WHERE abs(w.val - h.val) <= greatest(1e-12, 1e-12 * greatest(abs(w.val), abs(h.val)))) AS v, count(*) FILTER (WHERE w.category = h.category) AS c FROM pw w JOIN ph h USING ({_SHAPE}, sname, i) GROUP BY ALL),
sp AS (SELECT {_SHAPE}, sum((3.0 * coalesce(v, 0) / greatest(sw.n, sh.n) + coalesce(c, 0) / greatest(sw.n, sh.n) + 1) / 5) AS earned FROM sw JOIN sh USING ({_SHAPE}, sname) LEFT JOIN sv USING ({_SHAPE}, sname) GROUP BY ALL),
cn AS (SELECT {_SHAPE}, nw, nh FROM (SELECT {_SHAPE}, count(*) AS nw FROM sw GROUP BY ALL) a LEFT JOIN (SELECT {_SHAPE}, count(*) AS nh FROM sh GROUP BY ALL) b USING ({_SHAPE})),
cht AS (SELECT {_SHAPE}, (coalesce(earned, 0) / greatest(nw, coalesce(nh, 0)))::DOUBLE AS raw FROM cn LEFT JOIN sp USING ({_SHAPE}))
"""
SQL_RAW = _NUM + "," + SQL_CONTENT + "," + restored_sql(scenario=True) + f""",
raw AS MATERIALIZED (SELECT wd.scenario, nm.deck, nm.id, nm.op, nm.deg, CASE nm.op WHEN 'delete' THEN rst.raw WHEN 'move' THEN ({_CENTRE}) ELSE ({_FILL}) END::DOUBLE AS raw FROM nm JOIN wd ON wd.deck = nm.deck AND wd.slide = nm.slide AND wd.a_path = nm.gt_path
 JOIN rst ON rst.scenario = wd.scenario AND rst.deck = nm.deck AND rst.slide = nm.slide AND rst.path = nm.gt_path),
flo AS (SELECT deck, id, coalesce(raw, 0) AS floor FROM raw WHERE scenario = 'noop'),
stp AS (SELECT deck, deg, sum(est_steps) AS st FROM components GROUP BY ALL), cnt AS (SELECT deck, deg, count(*) AS n FROM components GROUP BY ALL),
wgt AS (SELECT deck, id, st / n / sum(st / n) OVER (PARTITION BY deck) AS weight FROM nm JOIN stp USING (deck, deg) JOIN cnt USING (deck, deg)),
scr AS (SELECT raw.*, floor, weight, CASE WHEN floor >= 1 THEN 0 ELSE greatest(0, least(1, (coalesce(raw, 0) - floor) / (1 - floor))) END AS score FROM raw JOIN flo USING (deck, id) JOIN wgt USING (deck, id))
"""


@query("component_scores", "P12", "WITH " + SQL_SCENE + "," + SQL_RAW + "SELECT scenario, deck, id, round(coalesce(raw, 0), 6) AS raw, round(floor, 6) AS floor, round(score, 6)::DOUBLE AS score FROM scr")
def component_scores(m):
    s = scoring(m).scores()
    return s.select("scenario", "deck", "id", F.round(F.coalesce("raw", F.lit(0.0)), 6).alias("raw"), F.round("floor", 6).alias("floor"), F.round("score", 6).alias("score"))


@query("unsatisfiable_components", "P3", "WITH " + SQL_SCENE + "," + SQL_RAW + "SELECT deck, id, op, round(coalesce(raw, 0), 6) AS raw FROM raw WHERE scenario = 'gt' AND NOT coalesce(raw >= 1 - 1e-9, false)")
def unsatisfiable_components(m):
    raw = scoring(m).raw().where(F.col("scenario") == "gt")
    comps = P.split_satisfiable(numbered(m), raw).where(~F.col("scoreable"))
    return comps.join(raw.select("deck", "id", "raw"), ["deck", "id"]).select("deck", "id", "op", F.round(F.coalesce("raw", F.lit(0.0)), 6).alias("raw"))


@query("high_floors", "P9", "WITH " + SQL_SCENE + "," + SQL_RAW + "SELECT deck, id, op, round_even(floor, 6)::DOUBLE AS floor FROM scr WHERE scenario = 'noop' AND floor > 0.15")
def high_floors(m):
    return P.high_floors(scoring(m).scores().where(F.col("scenario") == "noop"))


SQL_GATES = SQL_SCENE + f""",
g2 AS (SELECT DISTINCT scenario, deck FROM lo WHERE NOT hidden AND w * h / ({SLIDE_W}.0 * {SLIDE_H}) >= 0.8 AND (blob IS NOT NULL OR fill_type IS NOT NULL)),
nb AS (SELECT sn.scenario, b.* FROM (SELECT deck, slide, kind, path, cx, cy, w, h FROM shapes_input WHERE kind IN ('chart', 'table', 'smartart')) b CROSS JOIN sn),
g3 AS (SELECT DISTINCT nb.scenario, nb.deck FROM nb JOIN frames p ON p.scenario = nb.scenario AND p.deck = nb.deck AND p.slide = nb.slide AND p.blob IS NOT NULL AND abs(p.cx - nb.cx) <= greatest(9144, nb.w // 2) AND abs(p.cy - nb.cy) <= greatest(9144, nb.h // 2) AND nb.w > 0 AND nb.h > 0 AND p.w * p.h >= 0.5 * nb.w * nb.h
  WHERE NOT EXISTS (SELECT 1 FROM frames s WHERE s.scenario = nb.scenario AND s.deck = nb.deck AND s.slide = nb.slide AND s.kind = nb.kind AND abs(s.cx - nb.cx) <= greatest(9144, nb.w // 2) AND abs(s.cy - nb.cy) <= greatest(9144, nb.h // 2))),
sk AS (SELECT scenario, deck, slide, cx, cy, CASE WHEN placeholder IS NOT NULL THEN 'ph:' || placeholder WHEN blob IS NOT NULL THEN 'pic:' || blob WHEN kind IN ('table', 'chart', 'smartart') THEN kind WHEN plain <> '' THEN 'txt:' || plain END AS k FROM frames),
al AS (SELECT deck, slide, k, count(*) AS n FROM sk WHERE scenario = 'gt' AND k IS NOT NULL GROUP BY ALL), se AS (SELECT scenario, deck, slide, k, count(*) AS n FROM sk WHERE k IS NOT NULL GROUP BY ALL),
g4 AS (SELECT DISTINCT sk.scenario, sk.deck FROM sk JOIN se USING (scenario, deck, slide, k) JOIN al USING (deck, slide, k) JOIN rg ON rg.deck = sk.deck AND rg.slide = sk.slide WHERE se.n > al.n
  AND sk.cx BETWEEN rg.cx - rg.w // 2 - 228600 AND rg.cx - rg.w // 2 + rg.w + 228600 AND sk.cy BETWEEN rg.cy - rg.h // 2 - 228600 AND rg.cy - rg.h // 2 + rg.h + 228600),
sx AS (SELECT DISTINCT deck, blob AS sha FROM shapes_gt WHERE blob IS NOT NULL AND deckno % 5 = 0 AND (deck, blob) NOT IN (SELECT (deck, blob) FROM shapes_input WHERE blob IS NOT NULL)),
g5 AS (SELECT DISTINCT f.scenario, f.deck FROM frames f JOIN sx ON sx.deck = f.deck AND sx.sha = f.blob),
mk AS (SELECT DISTINCT scenario, deck, slide, plain AS mark FROM frames WHERE plain <> ''), mg AS (SELECT deck, slide, mark FROM mk WHERE scenario = 'gt'),
ng AS (SELECT deck, slide, count(*) AS n FROM mg GROUP BY ALL), nm2 AS (SELECT scenario, deck, slide, count(*) AS n FROM mk GROUP BY ALL),
ovl AS (SELECT mk.scenario, mk.deck, mg.slide AS gs, mk.slide AS ms, count(*) AS b FROM mk JOIN mg USING (deck, mark) GROUP BY ALL),
jc AS (SELECT ovl.*, b / (ng.n + nm2.n - b) AS j FROM ovl JOIN ng ON ng.deck = ovl.deck AND ng.slide = gs JOIN nm2 ON nm2.scenario = ovl.scenario AND nm2.deck = ovl.deck AND nm2.slide = ms),
pgs AS (SELECT DISTINCT deck, slide FROM shapes_gt), tl AS (SELECT DISTINCT deck FROM pgs WHERE (deck, slide) NOT IN (SELECT (deck, slide) FROM ng)),
it AS (SELECT sn.scenario, p.deck, p.slide, coalesce(ng.n, 0) < 2 OR coalesce(CASE WHEN nm2.n IS NULL THEN CASE WHEN p.deck IN (SELECT deck FROM tl) THEN 1.0 ELSE 0.0 END ELSE (SELECT max(j) FROM jc WHERE jc.scenario = sn.scenario AND jc.deck = p.deck AND jc.ms = p.slide) END, 0) <= coalesce((SELECT j FROM jc WHERE jc.scenario = sn.scenario AND jc.deck = p.deck AND jc.gs = p.slide AND jc.ms = p.slide), 0) + 0.2 AS itself
  FROM pgs p CROSS JOIN sn LEFT JOIN ng ON ng.deck = p.deck AND ng.slide = p.slide LEFT JOIN nm2 ON nm2.scenario = sn.scenario AND nm2.deck = p.deck AND nm2.slide = p.slide),
g1 AS (SELECT scenario, deck FROM it WHERE NOT itself AND (deck, slide) NOT IN (SELECT (deck, slide) FROM dp) UNION SELECT f.scenario, f.deck FROM (SELECT scenario, deck, count(DISTINCT slide) AS n FROM frames GROUP BY ALL) f JOIN (SELECT deck, count(DISTINCT slide) AS n FROM shapes_gt GROUP BY ALL) g USING (deck) WHERE f.n <> g.n),
gates AS MATERIALIZED (SELECT scenario, deck, 1 AS o, 'slide_count_and_order' AS gate FROM g1 UNION ALL SELECT scenario, deck, 2, 'no_full_page_overlay' FROM g2 UNION ALL SELECT scenario, deck, 3, 'native_objects_preserved' FROM g3 UNION ALL SELECT scenario, deck, 4, 'no_cloned_shapes' FROM g4 UNION ALL SELECT scenario, deck, 5, 'media_not_pasted' FROM g5)
"""


def _gates(m):
    rows = None
    for gate, df in scoring(m).failed_gates().items():
        part = df.select("scenario", "deck", F.lit(gate).alias("gate"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("failed_gates", "P14 P15 P16 P17 P18", "WITH " + SQL_GATES + "SELECT scenario, deck, gate FROM gates")
def failed_gates(m):
    return _gates(m)


@query("plan_accepted", "P13", "WITH " + _DG + ", nd AS (SELECT DISTINCT deck, deg FROM components), dd AS (SELECT DISTINCT deck, deg FROM dg), r AS (SELECT deck FROM nd WHERE (deck, deg) NOT IN (SELECT (deck, deg) FROM dd) UNION SELECT deck FROM dd WHERE (deck, deg) NOT IN (SELECT (deck, deg) FROM nd) UNION SELECT deck FROM dg WHERE est_steps <= 0) SELECT deck, deck NOT IN (SELECT deck FROM r) AS accepted FROM (SELECT DISTINCT deck FROM components)")
def plan_accepted(m):
    m.keep("components")
    findings = P.traceability(m["components"], degradations(m)).select("deck", F.lit(False).alias("ok")).distinct()
    return m["components"].select("deck").distinct().join(findings, "deck", "left").select("deck", F.coalesce("ok", F.lit(True)).alias("accepted"))


_FACTS_DIFFER = " OR ".join(f"a_{f} IS DISTINCT FROM b_{f}" for f in P.STABLE_FACTS)
SQL_COSTS = f"""
s1 AS (SELECT scenario, deck, count(*) AS n FROM (SELECT scenario, deck, slide FROM wd WHERE b_path IS NULL OR {_FACTS_DIFFER} UNION SELECT scenario, deck, slide FROM lo) WHERE (deck, slide) NOT IN (SELECT (deck, slide) FROM dp) GROUP BY ALL),
lst AS (SELECT * FROM wd WHERE b_path IS NULL),
s2 AS (SELECT l.scenario, l.deck, count(*) AS n FROM lst l WHERE (deck, slide) IN (SELECT (deck, slide) FROM dp) AND NOT EXISTS (SELECT 1 FROM rg WHERE rg.deck = l.deck AND rg.slide = l.slide AND (rg.path = l.a_path OR rg.path = l.a_grp))
  AND (a_kind <> 'group' OR EXISTS (SELECT 1 FROM lst k WHERE k.scenario = l.scenario AND k.deck = l.deck AND k.slide = l.slide AND k.a_grp = l.a_path)) GROUP BY ALL),
s3 AS (SELECT l.scenario, l.deck, count(*) AS n FROM lo l WHERE grp IS NULL AND (deck, slide) IN (SELECT (deck, slide) FROM dp)
  AND NOT (kind = 'group' AND EXISTS (SELECT 1 FROM frames k WHERE k.scenario = l.scenario AND k.deck = l.deck AND k.slide = l.slide AND k.grp = l.path) AND NOT EXISTS (SELECT 1 FROM lo k WHERE k.scenario = l.scenario AND k.deck = l.deck AND k.slide = l.slide AND k.grp = l.path))
  AND NOT EXISTS (SELECT 1 FROM rg WHERE rg.deck = l.deck AND rg.slide = l.slide AND l.cx BETWEEN rg.cx - rg.w // 2 - 228600 AND rg.cx - rg.w // 2 + rg.w + 228600 AND l.cy BETWEEN rg.cy - rg.h // 2 - 228600 AND rg.cy - rg.h // 2 + rg.h + 228600) GROUP BY ALL),
s4 AS (SELECT f.scenario, f.deck, 1 AS n FROM (SELECT scenario, deck, count(DISTINCT blob) AS n FROM frames GROUP BY ALL) f JOIN (SELECT deck, count(DISTINCT blob) AS n FROM shapes_input GROUP BY ALL) i USING (deck) WHERE f.n < i.n),
cost AS MATERIALIZED (SELECT scenario, deck, 'untouched_pages_unchanged' AS rule, n, least(0.30, 0.10 * n) AS cost FROM s1 UNION ALL SELECT scenario, deck, 'survivors_intact', n, least(0.30, 0.06 * n) FROM s2 UNION ALL SELECT scenario, deck, 'no_extra_shapes', n, least(0.20, 0.04 * n) FROM s3 UNION ALL SELECT scenario, deck, 'input_media_preserved', n, 0.15 FROM s4)
"""


@query("scope_penalties", "P19 P20 P21 P22 P23", "WITH " + SQL_SCENE + "," + SQL_COSTS + "SELECT scenario, deck, rule, n, round(cost, 4)::DOUBLE AS cost FROM cost")
def scope_penalties(m):
    return scoring(m).costs().withColumn("cost", F.round("cost", 4))


_FINAL = "WITH " + SQL_GATES + "," + SQL_COSTS + "," + SQL_RAW + """,
tt AS (SELECT scenario, deck, sum(weight * score) AS total FROM scr GROUP BY ALL), ff AS (SELECT scenario, deck, arg_min(gate, o) AS failed_gate FROM gates GROUP BY ALL), pp2 AS (SELECT scenario, deck, least(0.5, sum(cost)) AS penalty FROM cost GROUP BY ALL),
fin AS (SELECT scenario, deck, round_even(total, 6)::DOUBLE AS total, round_even(coalesce(penalty, 0), 4)::DOUBLE AS penalty, failed_gate, CASE WHEN failed_gate IS NOT NULL THEN 0.0 ELSE round_even(total * (1 - coalesce(penalty, 0)), 6) END::DOUBLE AS score FROM tt LEFT JOIN ff USING (scenario, deck) LEFT JOIN pp2 USING (scenario, deck))
"""


@query("final_scores", "P24", _FINAL + "SELECT * FROM fin")
def final_scores(m):
    return scoring(m).final()


@query("gate_reasons_across_states", "P25", "WITH " + SQL_GATES + "SELECT deck, gate, count(DISTINCT scenario) AS states, string_agg(DISTINCT scenario, ',' ORDER BY scenario) AS which FROM gates GROUP BY ALL")
def gate_reasons_across_states(m):
    """One finding per gate and deck however many states it fires in; the states are a fixed handful."""
    return _gates(m).distinct().groupBy("deck", "gate").agg(
        F.countDistinct("scenario").alias("states"), F.concat_ws(",", F.sort_array(F.collect_set("scenario"))).alias("which"))


@query("calibration_findings", "P26", _FINAL + "SELECT deck, scenario, score FROM fin WHERE (scenario = 'gt' AND abs(score - 1) > 1e-6) OR (scenario = 'noop' AND abs(score) > 1e-6)")
def calibration_findings(m):
    m.keep("shapes_gt")
    ends = ("gt", "noop")                                              # a state's score needs no other state but the broken file
    return P.calibration_findings(scoring(m, put_down(m["frames"].where(F.col("scenario").isin(*ends))), ends).final())
