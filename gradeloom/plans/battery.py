"""Queries for scenarios, variants and battery reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import battery as B
from gradeloom.operators import scoring as P
from gradeloom.operators.coherence import mixed
from gradeloom.operators.graded import Facts
from gradeloom.plans.coherence import _columns, _made, over_states
from gradeloom.plans.comparing import theme
from gradeloom.plans.models import _FRAME, SLIDE_H, SLIDE_W
from gradeloom.plans.registry import query
from gradeloom.plans.scoring import _NUM, MODEL_OPS, SQL_RAW, SQL_SCENE, _supplied, numbered, scoring, weighted
from gradeloom.session import put_down

_DP = "dp AS (SELECT DISTINCT deck, slide FROM components)"


def _per_deck(df):
    return df.groupBy("deck").agg(F.count(F.lit(1)).alias("n"), F.sum("cx").alias("sx"), F.sum("cy").alias("sy"), F.countDistinct("slide").alias("slides"))


_AGG = "SELECT deck, count(*) AS n, sum(cx)::BIGINT AS sx, sum(cy)::BIGINT AS sy, count(DISTINCT slide) AS slides FROM fr GROUP BY deck"


@query("scenario_noop_and_gt", "B1", "SELECT scenario, deck, count(*) AS n FROM (SELECT 'noop' AS scenario, deck FROM shapes_input UNION ALL SELECT 'gt', deck FROM shapes_gt) GROUP BY ALL")
def scenario_noop_and_gt(m):
    both = B.tagged(m["shapes_input"].select("deck"), "noop").unionByName(B.tagged(m["shapes_gt"].select("deck"), "gt"))
    return both.groupBy("scenario", "deck").agg(F.count(F.lit(1)).alias("n"))


@query("scenario_screenshot_paste", "B2", f"WITH {_DP}, fr AS (SELECT deck, slide, cx, cy FROM shapes_input UNION ALL SELECT deck, slide, {SLIDE_W // 2}, {SLIDE_H // 2} FROM dp) " + _AGG)
def scenario_screenshot_paste(m):
    return _per_deck(B.screenshot_paste(m["shapes_input"], m["components"], SLIDE_W, SLIDE_H))


@query("scenario_clone_spam", "B3", """
WITH best AS (SELECT deck, slide, name, w, h FROM shapes_input QUALIFY row_number() OVER (PARTITION BY deck, slide ORDER BY w * h DESC, z, path) = 1)
SELECT c.deck, c.slide, 'clone-' || gt_path AS path, c.cx, c.cy, b.w, b.h FROM components c JOIN best b USING (deck, slide) WHERE op = 'delete'""")
def scenario_clone_spam(m):
    out = B.clone_spam(m["shapes_input"], m["components"])
    return out.where(F.col("path").startswith("clone-")).select("deck", "slide", "path", "cx", "cy", "w", "h")


@query("scenario_native_to_picture", "B4", """
WITH h AS (SELECT DISTINCT deck, slide, gt_path AS path FROM components WHERE kind IN ('chart', 'table', 'smartart')),
fr AS (SELECT deck, slide, cx, cy FROM shapes_input WHERE (deck, slide, path) NOT IN (SELECT (deck, slide, path) FROM h) UNION ALL SELECT deck, slide, cx, cy FROM shapes_gt WHERE (deck, slide, path) IN (SELECT (deck, slide, path) FROM h)) """ + _AGG)
def scenario_native_to_picture(m):
    return _per_deck(B.native_to_picture(m["shapes_gt"], m["shapes_input"], m["components"]))


@query("scenario_page_delete", "B5", f"WITH {_DP}, l AS (SELECT deck, dense_rank() OVER (PARTITION BY deck ORDER BY slide) - 1 AS slide FROM shapes_input WHERE (deck, slide) NOT IN (SELECT (deck, slide) FROM dp)) SELECT deck, slide, count(*) AS n FROM l GROUP BY ALL")
def scenario_page_delete(m):
    return B.page_delete(m["shapes_input"], m["components"]).groupBy("deck", "slide").agg(F.count(F.lit(1)).alias("n"))


@query("scenario_duplicate_pages", "B5", f"WITH {_DP}, mx AS (SELECT deck, max(slide) AS last FROM shapes_input GROUP BY deck), pg AS (SELECT deck, slide, row_number() OVER (PARTITION BY deck ORDER BY slide) AS k FROM dp), fr AS (SELECT deck, slide, cx, cy FROM shapes_input UNION ALL SELECT g.deck, last + k, cx, cy FROM shapes_gt g JOIN pg USING (deck, slide) JOIN mx ON mx.deck = g.deck) " + _AGG)
def scenario_duplicate_pages(m):
    return _per_deck(B.duplicate_gt_slide(m["shapes_gt"], m["shapes_input"], m["components"]))


@query("scenario_rename_only", "B6", f"""
WITH {_DP}, h AS (SELECT DISTINCT deck, slide, gt_path AS path FROM components),
wn AS (SELECT g.deck, g.slide, g.name AS want, row_number() OVER (PARTITION BY g.deck, g.slide ORDER BY h.path IS NULL, z, g.path) AS i FROM shapes_gt g JOIN dp ON dp.deck = g.deck AND dp.slide = g.slide LEFT JOIN h ON h.deck = g.deck AND h.slide = g.slide AND h.path = g.path),
mi AS (SELECT deck, slide, path, name, row_number() OVER (PARTITION BY deck, slide ORDER BY z, path) AS i FROM shapes_input) SELECT mi.deck, mi.slide, mi.path, coalesce(want, name) AS name FROM mi LEFT JOIN wn USING (deck, slide, i)""")
def scenario_rename_only(m):
    return B.rename_only(m["shapes_gt"], m["shapes_input"], m["components"]).select("deck", "slide", "path", "name")


@query("scenario_orphan_media", "B7", "SELECT DISTINCT deck, blob AS sha FROM shapes_gt WHERE blob IS NOT NULL AND (deck, blob) NOT IN (SELECT (deck, blob) FROM shapes_input WHERE blob IS NOT NULL)")
def scenario_orphan_media(m):
    return B.orphan_media(P.media_of(m["shapes_gt"], ["deck"]), P.media_of(m["shapes_input"], ["deck"]))


@query("scenario_wrong_params", "B8", """
WITH o AS (SELECT deck, slide, gt_path AS path, bool_or(op IN ('move', 'delete')) AS mv, bool_or(op = 'delete') AS dl, bool_or(op = 'recolor') AS rc FROM components GROUP BY ALL)
SELECT g.deck, count(*) FILTER (WHERE mv) AS moved, count(*) FILTER (WHERE dl AND plain <> '') AS reworded, count(*) FILTER (WHERE rc) AS recoloured, 0::BIGINT AS left_correct FROM shapes_gt g LEFT JOIN o USING (deck, slide, path) GROUP BY g.deck""")
def scenario_wrong_params(m):
    wrong, untouched = B.wrong_params(m["shapes_gt"], numbered(m))
    was = m["shapes_gt"].select("deck", "slide", "path", F.col("cx").alias("ox"), F.col("plain").alias("op"), F.col("fill_color").alias("of"))
    per = wrong.join(was, ["deck", "slide", "path"]).groupBy("deck").agg(
        F.count_if(F.col("cx") != F.col("ox")).alias("moved"), F.count_if(F.col("plain") != F.col("op")).alias("reworded"),
        F.count_if(~F.col("fill_color").eqNullSafe(F.col("of"))).alias("recoloured"))
    left = untouched.groupBy("deck").agg(F.count(F.lit(1)).alias("left_correct"))
    return per.join(left, "deck", "left").fillna(0, ["left_correct"])


@query("scenario_damage_untouched", "B9", f"""
WITH {_DP}, f AS (SELECT deck, min(slide) AS slide FROM (SELECT DISTINCT deck, slide FROM shapes_input WHERE (deck, slide) NOT IN (SELECT (deck, slide) FROM dp)) GROUP BY deck),
t AS (SELECT s.deck, s.slide, path, row_number() OVER (PARTITION BY s.deck, s.slide ORDER BY z, path) AS i, count(*) OVER (PARTITION BY s.deck, s.slide) AS n FROM shapes_input s JOIN f USING (deck, slide) WHERE grp IS NULL),
fr AS (SELECT s.deck, s.slide, cx + CASE WHEN i IS NOT NULL THEN 914400 ELSE 0 END AS cx, cy + CASE WHEN i IS NOT NULL THEN 914400 ELSE 0 END AS cy FROM shapes_input s LEFT JOIN t USING (deck, slide, path) WHERE i IS NULL OR i <= n - n // 2) """ + _AGG)
def scenario_damage_untouched(m):
    return _per_deck(B.damage_untouched(m["shapes_input"], m["components"]))


_UNITCOMP = "SELECT * FROM {src} WHERE slide % 5 = CAST(right(deg, 1) AS BIGINT) % 5 OR (slide = 6 AND deg IN ('d1', 'd2'))"


@query("work_units", "B11", "WITH RECURSIVE c AS (" + _UNITCOMP.replace("{src}", "components") + """), nd AS (SELECT DISTINCT deck, slide, deg FROM c),
r AS (SELECT DISTINCT deck, deg, deg AS reach FROM nd UNION SELECT r.deck, r.deg, b.deg FROM r JOIN nd a ON a.deck = r.deck AND a.deg = r.reach JOIN nd b ON b.deck = a.deck AND b.slide = a.slide)
SELECT deck, deg, min(reach) AS unit FROM r GROUP BY deck, deg""")
def work_units(m):
    return B.merge_units(m.sql(_UNITCOMP.replace("{src}", "{components}")))


@query("half_restore", "B10", """
WITH u AS (SELECT deck, deg AS unit, sum(est_steps) / sum(sum(est_steps)) OVER (PARTITION BY deck) AS weight, row_number() OVER (PARTITION BY deck ORDER BY deg) - 1 AS i FROM components GROUP BY deck, deg),
n AS (SELECT deck, count(*) AS n FROM u GROUP BY deck), k AS (SELECT deck, unnest(range(0, (1 << n)::BIGINT)) AS mask FROM n),
s AS (SELECT k.deck, mask, coalesce(sum(weight) FILTER (WHERE (mask >> i) & 1 = 1), 0) AS mass, count(*) FILTER (WHERE (mask >> i) & 1 = 1) AS c FROM k JOIN u ON u.deck = k.deck GROUP BY ALL),
b AS (SELECT s.deck, mass, c FROM s JOIN n ON n.deck = s.deck WHERE c > 0 AND c < n.n QUALIFY row_number() OVER (PARTITION BY s.deck ORDER BY round_even(abs(mass - 0.5), 9), c, mask) = 1)
SELECT n.deck, round(mass, 9)::DOUBLE AS mass, c AS units FROM n LEFT JOIN b ON b.deck = n.deck""")
def half_restore(m):
    out = B.half_restore(m["components"].groupBy("deck", F.col("deg").alias("unit")).agg(F.sum("est_steps").alias("steps")))
    n = F.when(F.col("units").isNotNull(), F.size(F.split("units", ",")))
    return out.select("deck", F.round("mass", 9).alias("mass"), n.cast("long").alias("units"))


_HIT = "h AS (SELECT DISTINCT deck, slide, gt_path AS path FROM components)"


@query("variant_rebuilt", "B12", f"WITH {_HIT}, n AS (SELECT g.*, h.path IS NOT NULL AND grp IS NULL AS nw FROM shapes_gt g LEFT JOIN h ON h.deck = g.deck AND h.slide = g.slide AND h.path = g.path) SELECT deck, slide, path, row_number() OVER (PARTITION BY deck, slide ORDER BY nw, z, path) - 1 AS z, shape_id + CASE WHEN nw THEN 1000000 ELSE 0 END AS shape_id FROM n")
def variant_rebuilt(m):
    return B.rebuilt_shapes(m["shapes_gt"], m["components"]).select("deck", "slide", "path", "z", F.col("shape_id").cast("long").alias("shape_id"))


@query("variant_regrouped", "B23", f"WITH {_HIT}, d AS (SELECT g.* FROM shapes_gt g JOIN h USING (deck, slide, path) WHERE grp IS NULL AND kind <> 'group') SELECT deck, slide, count(*) AS members, floor((min(cx - w / 2) + max(cx + w / 2)) / 2)::BIGINT AS cx, floor(max(cy + h / 2) - min(cy - h / 2))::BIGINT AS h FROM d GROUP BY ALL HAVING count(*) >= 2")
def variant_regrouped(m):
    out = B.regrouped(m["shapes_gt"], m["components"])
    members = out.where(F.col("grp") == "g").groupBy("deck", "slide").agg(F.count(F.lit(1)).alias("members"))
    return out.where(F.col("path") == "g").join(members, ["deck", "slide"]).select("deck", "slide", "members", "cx", "h")


@query("variant_ungrouped", "B24", f"WITH {_HIT}, o AS (SELECT DISTINCT k.deck, k.slide, k.grp FROM shapes_gt k JOIN h USING (deck, slide, path) JOIN shapes_gt g ON g.deck = k.deck AND g.slide = k.slide AND g.path = k.grp AND g.kind = 'group' AND g.rot = 0) SELECT s.deck, s.slide, s.path, CASE WHEN o.grp IS NULL THEN s.grp END AS grp FROM shapes_gt s LEFT JOIN o ON o.deck = s.deck AND o.slide = s.slide AND o.grp = s.grp WHERE (s.deck, s.slide, s.path) NOT IN (SELECT (deck, slide, grp) FROM o)")
def variant_ungrouped(m):
    return B.ungrouped(m["shapes_gt"], m["components"]).select("deck", "slide", "path", "grp")


@query("variant_text_retyped", "B25", "SELECT doc_id, sum(CASE WHEN doc_id % 2 = 0 AND length(t) >= 4 THEN 2 ELSE 1 END)::BIGINT AS runs, sum(length(t))::BIGINT AS chars FROM word_runs GROUP BY doc_id")
def variant_text_retyped(m):
    out = B.text_retyped(m["word_runs"], m["documents"].where("doc_id % 2 = 0"), ["doc_id"])
    return out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("runs"), F.sum(F.length("t")).alias("chars"))


@query("variant_picture_reinserted", "B26", f"WITH {_HIT}, m AS (SELECT g.*, h.path IS NOT NULL AND blob IS NOT NULL AS nw, max(z) OVER (PARTITION BY g.deck, g.slide, coalesce(grp, '')) AS last FROM shapes_gt g LEFT JOIN h ON h.deck = g.deck AND h.slide = g.slide AND h.path = g.path) SELECT deck, slide, path, last + 1 + z AS z, shape_id + 1000000 AS shape_id FROM m WHERE nw")
def variant_picture_reinserted(m):
    out = B.picture_reinserted(m["shapes_gt"], m["components"])
    return out.where(F.col("name") == "Picture 1").select("deck", "slide", "path", "z", F.col("shape_id").cast("long").alias("shape_id"))


@query("variant_colour_written_out", "B27", f"WITH {_HIT}, x AS (SELECT g.*, h.path IS NOT NULL AS hit FROM shapes_gt g LEFT JOIN h ON h.deck = g.deck AND h.slide = g.slide AND h.path = g.path) SELECT deck, slide, path, CASE WHEN hit THEN CASE fill_color WHEN 'scheme:ACCENT1' THEN 'srgb:4472C4' WHEN 'scheme:ACCENT2' THEN 'srgb:ED7D31' WHEN 'scheme:ACCENT3' THEN 'srgb:A5A5A5' ELSE fill_color END ELSE fill_color END AS fill_color, CASE WHEN hit AND line_color = 'scheme:TX1' THEN 'srgb:000000' ELSE line_color END AS line_color FROM x")
def variant_colour_written_out(m):
    return B.colour_written_out(m["shapes_gt"], m["components"], theme(m)).select("deck", "slide", "path", "fill_color", "line_color")


@query("graded_paths", "B13", "SELECT DISTINCT deck, slide, gt_path AS path FROM components WHERE op = 'move'")
def graded_paths(m):
    return B.graded_paths(m["components"], ["move"])


def _halves(m):
    """Shapes of the degradations that come nearest half of a deck's steps."""
    units = B.half_restore(m["components"].groupBy("deck", F.col("deg").alias("unit")).agg(F.sum("est_steps").alias("steps")))
    chosen = units.where("units IS NOT NULL").select("deck", F.explode(F.split("units", ",")).alias("deg"))
    return m["components"].join(chosen, ["deck", "deg"], "left_semi").select("deck", "slide", F.col("gt_path").alias("path")).distinct()


def _withheld(m):
    return B.orphan_media(P.media_of(m["shapes_gt"], ["deck"]), P.media_of(m["shapes_input"], ["deck"]))


def _status(m):
    expected = m.spark.createDataFrame(B.EXPECTED, B.EXPECTED_SCHEMA)
    return B.attack_status(m["shapes_gt"], m["components"], _withheld(m), _halves(m), expected), expected


def _battery(m, variants=False):
    """One scoring pass over the frames of all attacks, or of all variants beside the answer and the broken file."""
    cols = _FRAME.split(", ")
    m.unpacked()
    comps = put_down(weighted(m))
    gt, broken = m["shapes_gt"].select(*cols), m["shapes_input"].select(*cols)
    halves = put_down(_halves(m))
    if variants:
        made = {"gt": gt, "noop": broken} | B.variant_frames(gt, comps, theme(m))
    else:
        made = B.attack_frames(gt, broken, comps, halves, SLIDE_W, SLIDE_H)
    frames = None
    for name, frame in made.items():
        frame = B.tagged(frame.select(*cols), name)
        frames = frame if frames is None else frames.unionByName(frame)
    frames = put_down(frames)
    own = gt.select("deck", "slide", "path")
    mended = halves.select(F.lit("half_restore").alias("scenario"), "deck", "slide", "path")
    for name in made:
        if name in ("gt", "damage_untouched_gt") or name.startswith("variant_"):
            mended = mended.unionByName(own.select(F.lit(name).alias("scenario"), "*"))
    names = m.spark.createDataFrame([(n,) for n in made if n != "wrong_params"], "scenario string")
    damaged = comps.where("op = 'delete'").select("deck", "slide", F.col("gt_path").alias("path"), F.lit(True).alias("hit")).distinct()

    def child(name, *columns, **wrong):
        whole, rest = m[name].select("deck", "slide", "path", *columns), m[f"{name}_candidate"].select("deck", "slide", "path", *columns)
        bad = whole.join(damaged, ["deck", "slide", "path"], "left").withColumns({c: F.when(F.col("hit"), x).otherwise(F.col(c)) for c, x in wrong.items()})
        rows = mixed(whole, rest, mended, names)
        return whole, rows if variants else rows.unionByName(B.tagged(bad, "wrong_params").select(*rows.columns))

    none = m.spark.createDataFrame([], "deck string, id string, what string, i long, j long, t string, u string")
    facts = Facts(none, cells=child("cells", "r", "c", "text", text=F.concat("text", F.lit(" wrong"))),
                  series=child("series", "sno", "sname", "i", "val", "category", val=F.col("val") + 1))
    return P.Scoring(m["shapes_gt"], m["shapes_input"], frames, comps, _supplied(m), SLIDE_W, SLIDE_H, theme(m), MODEL_OPS, facts,
                     None if variants else _withheld(m).withColumn("scenario", F.lit("orphan_media")))


def rows(m):
    """Every attack on every deck, built and scored; the barrier a run had is a recorded fact of its deck."""
    m.keep("shapes_gt")
    status, expected = _status(m)
    scored = _battery(m)
    scores = put_down(scored.scores())                                # read by the totals and by the credit before the floor
    final = P.final_scores(scores, scored.failed_gates(), scored.costs())
    return B.battery_rows(status, final, scores, expected).join(_barrier(m), "deck")


def _barrier(m):
    return m["shapes_gt"].groupBy("deck").agg((F.max("deckno") % 4 == 0).alias("weak_barrier"))


def _changed(scenario, source, /, **change):
    return f"SELECT '{scenario}' AS scenario, {_columns(**change)} FROM {source}"


_HITS = "b_h AS (SELECT deck, slide, gt_path AS path, bool_or(op IN ('move', 'delete')) AS mv, bool_or(op = 'delete') AS dl, bool_or(op = 'recolor') AS rc, bool_or(kind IN ('chart', 'table', 'smartart')) AS nat FROM components GROUP BY ALL)"
_BUILT = f"""b_dp AS (SELECT deck, slide, row_number() OVER (PARTITION BY deck ORDER BY slide) AS k FROM (SELECT DISTINCT deck, slide FROM components)), {_HITS},
b_g AS (SELECT g.*, mv, dl, rc, nat FROM shapes_gt g LEFT JOIN b_h USING (deck, slide, path)), b_i AS (SELECT i.*, nat FROM shapes_input i LEFT JOIN b_h USING (deck, slide, path)),
b_u AS (SELECT deck, deg, sum(est_steps) AS st, row_number() OVER (PARTITION BY deck ORDER BY deg) - 1 AS i, count(*) OVER (PARTITION BY deck) AS n, sum(sum(est_steps)) OVER (PARTITION BY deck) AS total FROM components GROUP BY deck, deg),
b_k AS (SELECT DISTINCT deck, n, total, unnest(range(1, (1 << n)::BIGINT - 1)) AS mask FROM b_u),
b_m AS (SELECT b_k.deck, mask FROM b_k JOIN b_u ON b_u.deck = b_k.deck WHERE (mask >> i) & 1 = 1 GROUP BY b_k.deck, mask, b_k.total QUALIFY row_number() OVER (PARTITION BY b_k.deck ORDER BY abs(2 * sum(st) - b_k.total), count(*), mask) = 1),
b_hv AS (SELECT DISTINCT c.deck, c.slide, c.gt_path AS path FROM components c JOIN b_u USING (deck, deg) JOIN b_m ON b_m.deck = c.deck AND (mask >> b_u.i) & 1 = 1),
b_wm AS (SELECT DISTINCT deck FROM shapes_gt WHERE blob IS NOT NULL AND (deck, blob) NOT IN (SELECT (deck, blob) FROM shapes_input WHERE blob IS NOT NULL)),
b_sp AS (SELECT deck, min(slide) AS slide FROM (SELECT DISTINCT deck, slide FROM shapes_gt WHERE (deck, slide) NOT IN (SELECT (deck, slide) FROM b_dp)) GROUP BY deck),
b_si AS (SELECT deck, min(slide) AS slide FROM (SELECT DISTINCT deck, slide FROM shapes_input WHERE (deck, slide) NOT IN (SELECT (deck, slide) FROM b_dp)) GROUP BY deck),
b_bg AS (SELECT s.deck, s.slide, path, row_number() OVER (PARTITION BY s.deck, s.slide ORDER BY z, path) AS i, count(*) OVER (PARTITION BY s.deck, s.slide) AS n FROM shapes_gt s JOIN b_sp USING (deck, slide) WHERE grp IS NULL),
b_bi AS (SELECT s.deck, s.slide, path, row_number() OVER (PARTITION BY s.deck, s.slide ORDER BY z, path) AS i, count(*) OVER (PARTITION BY s.deck, s.slide) AS n FROM shapes_input s JOIN b_si USING (deck, slide) WHERE grp IS NULL),
b_big AS (SELECT * FROM shapes_input QUALIFY row_number() OVER (PARTITION BY deck, slide ORDER BY w * h DESC, z, path) = 1),
b_cl AS (SELECT b.* REPLACE ('clone-' || c.gt_path AS path, 'copy ' || c.gt_path AS name, c.cx AS cx, c.cy AS cy, NULL AS grp, b.shape_id + 1000000 AS shape_id) FROM components c JOIN b_big b USING (deck, slide) WHERE c.op = 'delete'),
b_mx AS (SELECT deck, max(slide) AS last FROM shapes_input GROUP BY deck),
b_wn AS (SELECT g.deck, g.slide, g.name AS want, row_number() OVER (PARTITION BY g.deck, g.slide ORDER BY b_h.path IS NULL, z, g.path) AS i FROM shapes_gt g JOIN b_dp ON b_dp.deck = g.deck AND b_dp.slide = g.slide LEFT JOIN b_h ON b_h.deck = g.deck AND b_h.slide = g.slide AND b_h.path = g.path),
b_rn AS (SELECT i.* REPLACE (coalesce(want, name) AS name) FROM (SELECT *, row_number() OVER (PARTITION BY deck, slide ORDER BY z, path) AS i FROM shapes_input) i LEFT JOIN b_wn USING (deck, slide, i)),
"""
_DOWN = {"cx": "cx + CASE WHEN i IS NOT NULL THEN 914400 ELSE 0 END", "cy": "cy + CASE WHEN i IS NOT NULL THEN 914400 ELSE 0 END"}
_ATTACKED = [
    _changed("noop", "shapes_input"), _changed("gt", "shapes_gt"), _changed("orphan_media", "shapes_input"), _changed("screenshot_paste", "shapes_input"),
    "SELECT 'screenshot_paste', " + _made(path="'cover'", kind="'picture'", z="1000000", shape_id="1000000", name="'cover'", plain="''", blob="'cover'", cx=f"{SLIDE_W // 2}", cy=f"{SLIDE_H // 2}", w=f"{SLIDE_W}", h=f"{SLIDE_H}") + " FROM b_dp",
    _changed("clone_spam", "shapes_input"), _changed("clone_spam", "b_cl"),
    _changed("native_to_picture", "b_i WHERE nat IS NOT TRUE"), _changed("native_to_picture", "b_g WHERE nat", kind="'picture'", blob="'flat'", plain="''"),
    f"SELECT 'page_delete' AS scenario, {_columns(slide='dense_rank() OVER (PARTITION BY deck ORDER BY slide) - 1')} FROM shapes_input WHERE (deck, slide) NOT IN (SELECT (deck, slide) FROM b_dp)",
    _changed("rename_only", "b_rn"), _changed("duplicate_gt_slide", "shapes_input"),
    _changed("duplicate_gt_slide", "(SELECT g.* REPLACE (last + k AS slide) FROM shapes_gt g JOIN b_dp USING (deck, slide) JOIN b_mx ON b_mx.deck = g.deck)"),
    _changed("wrong_params", "b_g", cx="cx + CASE WHEN mv THEN 2000000 ELSE 0 END", plain="CASE WHEN dl AND plain <> '' THEN plain || ' wrong' ELSE plain END",
             blob="CASE WHEN dl AND blob IS NOT NULL THEN 'wrongwrongwrong0' ELSE blob END", fill_color="CASE WHEN rc THEN 'srgb:010203' ELSE fill_color END"),
    _changed("damage_untouched", "(SELECT s.*, i, n FROM shapes_input s LEFT JOIN b_bi USING (deck, slide, path)) WHERE i IS NULL OR i <= n - n // 2", **_DOWN),
    _changed("damage_untouched_gt", "(SELECT s.*, i, n FROM shapes_gt s LEFT JOIN b_bg USING (deck, slide, path)) WHERE i IS NULL OR i <= n - n // 2", **_DOWN),
    _changed("half_restore", "shapes_input WHERE (deck, slide, path) NOT IN (SELECT (deck, slide, path) FROM b_hv)"), _changed("half_restore", "shapes_gt WHERE (deck, slide, path) IN (SELECT (deck, slide, path) FROM b_hv)")]
_ACCENT = "CASE fill_color WHEN 'scheme:ACCENT1' THEN 'srgb:4472C4' WHEN 'scheme:ACCENT2' THEN 'srgb:ED7D31' WHEN 'scheme:ACCENT3' THEN 'srgb:A5A5A5' ELSE fill_color END"
_VARIED = [
    _changed("noop", "shapes_input"), _changed("gt", "shapes_gt"),
    _changed("variant_rebuilt", "(SELECT *, mv IS NOT NULL AND grp IS NULL AS nw FROM b_g)", z="row_number() OVER (PARTITION BY deck, slide ORDER BY nw, z, path) - 1",
             shape_id="shape_id + CASE WHEN nw THEN 1000000 ELSE 0 END", name="CASE WHEN nw THEN upper(kind[1]) || lower(kind[2:]) || ' 1' ELSE name END"),
    _changed("variant_ungrouped", "(SELECT s.* REPLACE (CASE WHEN o.grp IS NULL THEN s.grp END AS grp) FROM shapes_gt s LEFT JOIN b_o o ON o.deck = s.deck AND o.slide = s.slide AND o.grp = s.grp WHERE (s.deck, s.slide, s.path) NOT IN (SELECT (deck, slide, grp) FROM b_o))"),
    _changed("variant_picture", "(SELECT *, mv IS NOT NULL AND blob IS NOT NULL AS nw, max(z) OVER (PARTITION BY deck, slide, coalesce(grp, '')) AS last FROM b_g)", z="CASE WHEN nw THEN last + 1 + z ELSE z END",
             shape_id="shape_id + CASE WHEN nw THEN 1000000 ELSE 0 END", name="CASE WHEN nw THEN 'Picture 1' ELSE name END"),
    _changed("variant_colour", "b_g", fill_color=f"CASE WHEN mv IS NOT NULL THEN {_ACCENT} ELSE fill_color END", line_color="CASE WHEN mv IS NOT NULL AND line_color = 'scheme:TX1' THEN 'srgb:000000' ELSE line_color END")]
_FREED = "b_o AS (SELECT DISTINCT k.deck, k.slide, k.grp FROM b_g k JOIN shapes_gt g ON g.deck = k.deck AND g.slide = k.slide AND g.path = k.grp AND g.kind = 'group' AND g.rot = 0 WHERE k.mv IS NOT NULL),\n"
_WRONG = {"cells": {"text": "text || ' wrong'"}, "series": {"val": "val + 1"}}


def _wrong_rows(name, columns):
    made = ", ".join(f"CASE WHEN dl THEN {_WRONG[name][c]} ELSE {c} END AS {c}" if c in _WRONG[name] else c for c in columns.split(", "))
    return f" UNION ALL SELECT 'wrong_params', deck, slide, path, {made} FROM {name} LEFT JOIN b_h USING (deck, slide, path)"


_MENDED = """s_md AS MATERIALIZED (SELECT x.scenario, deck, slide, path FROM shapes_gt CROSS JOIN (SELECT unnest(['gt', 'damage_untouched_gt', 'variant_rebuilt', 'variant_ungrouped', 'variant_picture', 'variant_colour']) AS scenario) x
 UNION ALL SELECT 'half_restore', deck, slide, path FROM b_hv UNION ALL SELECT 'wrong_params', deck, slide, path FROM cells UNION ALL SELECT 'wrong_params', deck, slide, path FROM series),
"""


def _battery_sql() -> str:
    body = "WITH " + _NUM + ",\n" + _BUILT + over_states(_ATTACKED, _MENDED, _wrong_rows, "wrong_params")
    return body.replace(
        "JOIN sx ON sx.deck = f.deck AND sx.sha = f.blob)", "JOIN sx ON sx.deck = f.deck AND sx.sha = f.blob UNION SELECT 'orphan_media', deck FROM sx)")


_EXPECTED = ", ".join(f"('{a}', '{k}', {lo!r}::DOUBLE, {hi!r}::DOUBLE, {tol!r}::DOUBLE, {repr(ref) if ref else 'NULL'}, {gap!r}::DOUBLE)" for a, k, lo, hi, tol, ref, gap in B.EXPECTED)
_STATUS = f"""b_ex(attack, expect_kind, lo, hi, tol, ref, gap) AS (VALUES {_EXPECTED}),
b_hs AS (SELECT deck, bool_or(op = 'delete') AS holes, coalesce(bool_or(kind IN ('chart', 'table', 'smartart')), false) AS native FROM components GROUP BY deck),
b_st AS (SELECT deck, attack, CASE WHEN attack = 'gt_roundtrip' THEN 'not_run' WHEN attack = 'clone_spam' AND NOT holes THEN 'n/a' WHEN attack = 'native_to_picture' AND NOT native THEN 'n/a'
  WHEN attack = 'orphan_media' AND deck NOT IN (SELECT deck FROM b_wm) THEN 'n/a' WHEN starts_with(attack, 'damage_untouched') AND deck NOT IN (SELECT deck FROM b_sp) THEN 'no_material'
  WHEN attack = 'half_restore' AND deck NOT IN (SELECT deck FROM b_hv) THEN 'no_material' ELSE 'scored' END AS status FROM b_hs CROSS JOIN b_ex)"""
_COUNTED = "WITH " + _BUILT + _STATUS
_BR = _battery_sql() + "," + _STATUS + f""",
b_al AS (SELECT scenario, deck, sum(weight * greatest(0, coalesce(raw, 0))) AS already FROM scr GROUP BY ALL),
br AS (SELECT s.deck, s.attack, s.status, CASE WHEN s.status = 'scored' THEN fin.score END AS score, fin.failed_gate, al.already, e.* EXCLUDE (attack) FROM b_st s JOIN b_ex e USING (attack)
  LEFT JOIN fin ON fin.deck = s.deck AND fin.scenario = s.attack LEFT JOIN b_al al ON al.deck = s.deck AND al.scenario = s.attack),
jo AS (SELECT br.*, b.score AS base FROM br LEFT JOIN br b ON b.deck = br.deck AND b.attack = br.ref AND b.status = 'scored'),
ck AS (SELECT *, CASE WHEN status = 'scored' THEN coalesce(CASE expect_kind WHEN 'exact' THEN abs(score - lo) <= tol WHEN 'at_most' THEN score <= hi + 1e-9 WHEN 'between' THEN score BETWEEN lo - 1e-9 AND hi + 1e-9 WHEN 'no_gain' THEN score <= base + 1e-6
  WHEN 'costs' THEN base >= gap AND score <= base - gap + 1e-6 ELSE abs(score) <= 1e-9 AND already <= hi + 1e-9 END, false) END AS ok FROM jo),
nt AS (SELECT deck, attack, CASE WHEN status = 'scored' AND NOT ok THEN CASE WHEN attack = 'half_restore' THEN 'warning' ELSE 'reason' END ELSE 'warning' END AS level, coalesce(failed_gate, '') AS note FROM ck WHERE (status = 'scored' AND NOT ok) OR status IN ('unconstructible', 'not_run', 'error')
  UNION ALL SELECT deck, '*', 'reason', 'nothing could be scored' FROM ck GROUP BY deck HAVING NOT bool_or(status = 'scored') AND bool_or(status = 'no_material'))
"""


@query("battery_scores", "B1 B2 B3 B4 B5 B6 B7 B9 B10", _BR + "SELECT deck, attack, status, score, failed_gate FROM br")
def battery_scores(m):
    """Every attack on every deck with its score and the gate that stopped it."""
    return rows(m).select("deck", "attack", "status", "score", "failed_gate")


@query("expectation_check", "B14", _BR + " SELECT deck, attack, ok FROM ck")
def expectation_check(m):
    return B.check_expectations(rows(m)).select("deck", "attack", "ok")


@query("variant_check", "B15", "WITH " + _NUM + ",\n" + _BUILT + _FREED + over_states(_VARIED, _MENDED) + """, b_ls AS (SELECT scenario, deck, round(max(weight * (1 - score)), 6)::DOUBLE AS worst_loss FROM scr WHERE weight * (1 - score) > 0 GROUP BY ALL)
SELECT v.scenario, v.deck, v.score, v.failed_gate IS NULL AND v.score >= g.score - 0.02 AS ok, worst_loss FROM fin v JOIN fin g ON g.deck = v.deck AND g.scenario = 'gt' LEFT JOIN b_ls ON b_ls.scenario = v.scenario AND b_ls.deck = v.deck WHERE v.scenario <> 'gt'""")
def variant_check(m):
    m.keep("shapes_gt")
    s = _battery(m, variants=True)
    verdicts, losers = B.check_variants(s.final(), s.scores())
    worst = losers.groupBy("scenario", "deck").agg(F.round(F.max("loss"), 6).alias("worst_loss"))
    return verdicts.join(worst, ["scenario", "deck"], "left")


@query("top_paid_components", "B16", "WITH " + SQL_SCENE + "," + SQL_RAW + "SELECT scenario, deck, id, round(weight * score, 6)::DOUBLE AS paid, row_number() OVER (PARTITION BY scenario, deck ORDER BY weight * score DESC, id) AS place FROM scr WHERE weight * score > 0 QUALIFY place <= 2")
def top_paid_components(m):
    return B.top_paid(scoring(m).scores()).select("scenario", "deck", "id", F.round("paid", 6).alias("paid"), F.col("place").cast("long").alias("place"))


@query("battery_coverage", "B17", _COUNTED + " SELECT deck, count(*) AS total, count(*) FILTER (WHERE status = 'scored') AS scored, count(*) FILTER (WHERE status = 'n/a') AS na, count(*) FILTER (WHERE status = 'no_material') AS no_material, count(*) FILTER (WHERE status = 'unconstructible') AS unconstructible, count(*) FILTER (WHERE status = 'error') AS error, count(*) FILTER (WHERE status = 'not_run') AS not_run FROM b_st GROUP BY deck")
def battery_coverage(m):
    m.keep("shapes_gt")
    return B.coverage(_status(m)[0])


@query("reasons_and_warnings", "B18", _BR + " SELECT deck, attack, level, note FROM nt")
def reasons_and_warnings(m):
    return B.reasons_and_warnings(B.check_expectations(rows(m)))


@query("cross_deck_summary", "B19", _BR + " SELECT attack, count(DISTINCT deck) AS decks FROM nt WHERE level = 'reason' GROUP BY attack UNION ALL SELECT 'survivors', count(*) FROM (SELECT DISTINCT deck FROM b_st) WHERE deck NOT IN (SELECT deck FROM nt WHERE level = 'reason')")
def cross_deck_summary(m):
    notes = B.reasons_and_warnings(B.check_expectations(rows(m)))
    return B.cross_deck_summary(notes, m["components"].select("deck").distinct())


_FACTS = "SELECT doc_id AS deck, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE n_chars END AS saved_bytes, CASE WHEN doc_id % 7 = 0 THEN 'zz' ELSE {sha} END AS source_sha, {sha} AS actual_sha, CASE WHEN doc_id % 11 = 0 THEN {sha} ELSE md5(text) END AS saved_sha, doc_id % 4 AS differing FROM documents"


@query("roundtrip_evidence", "B20", "WITH f AS (" + _FACTS.replace("{sha}", "sha256(text)") + ") SELECT deck, 'saved file is empty' AS problem FROM f WHERE saved_bytes <= 0 UNION ALL SELECT deck, 'source digest malformed' FROM f WHERE source_sha = 'zz' UNION ALL SELECT deck, 'recorded for another source' FROM f WHERE source_sha <> actual_sha UNION ALL SELECT deck, 'nothing was saved' FROM f WHERE saved_sha = source_sha UNION ALL SELECT deck, 'no part differs' FROM f WHERE differing = 0")
def roundtrip_evidence(m):
    return B.roundtrip_problems(m.sql(_FACTS.replace("{sha}", "sha2(text, 256)").replace("FROM documents", "FROM {documents}")))


@query("differing_parts", "B21", "WITH b AS (SELECT deck, part, CASE WHEN length(part) % 3 = 0 THEN 'x' ELSE sha END AS sha FROM parts WHERE length(part) % 7 <> 0) SELECT deck, count(*) FILTER (WHERE a.sha IS DISTINCT FROM b.sha) AS differing FROM parts a FULL JOIN b USING (deck, part) GROUP BY deck")
def differing_parts(m):
    a = m["parts"].select("deck", "part", "sha")
    b = a.where(F.length("part") % 7 != 0).withColumn("sha", F.when(F.length("part") % 3 == 0, "x").otherwise(F.col("sha")))
    return B.differing_parts(a, b)


@query("hardening_caveats", "B22", _COUNTED + """ SELECT deck, CASE status WHEN 'no_material' THEN 'no material' WHEN 'not_run' THEN 'not run' ELSE 'weak barrier' END AS caveat, attack
FROM b_st JOIN (SELECT deck, max(deckno) % 4 = 0 AS weak_barrier FROM shapes_gt GROUP BY deck) USING (deck) WHERE status IN ('no_material', 'not_run') OR (status = 'scored' AND weak_barrier)""")
def hardening_caveats(m):
    m.keep("shapes_gt")
    return B.hardening_caveats(_status(m)[0].join(_barrier(m), "deck"))
