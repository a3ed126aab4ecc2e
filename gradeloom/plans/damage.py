"""Queries for recorded damage; each reports the change log of one operation over the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import damage as D
from gradeloom.plans.comparing import runs_by_document
from gradeloom.plans.registry import query

_LOG = "SELECT deck, slide, path, '{op}' AS op, deg, '{f}' AS fact, {was}::VARCHAR AS was, {now}::VARCHAR AS now FROM hit WHERE {was} IS DISTINCT FROM {now}"
_DEG = "'d' || (ln % 5 + 1) AS deg"


def steps(m, cond, **params):
    rows = m["shapes_gt"].where(cond)
    return rows.select("deck", "slide", "path", F.concat(F.lit("d"), (F.col("ln") % 5 + 1).cast("string")).alias("deg"),
                       *[(F.expr(v) if isinstance(v, str) else F.lit(v)).alias(k) for k, v in params.items()])


def log_sql(op, cond, **facts):
    return f"WITH hit AS (SELECT *, {_DEG} FROM shapes_gt WHERE {cond}) " + " UNION ALL ".join(
        _LOG.format(op=op, f=f, was=f, now=f"({now})") for f, now in facts.items())


@query("damage_delete", "K1", "WITH hit AS (SELECT *, " + _DEG + """ FROM shapes_gt WHERE qty % 6 = 0), al AS (SELECT deck, slide, path, kind, deg FROM hit UNION ALL SELECT g.deck, g.slide, g.path, g.kind, h.deg FROM shapes_gt g JOIN hit h ON h.deck = g.deck AND h.slide = g.slide AND g.grp = h.path)
SELECT deck, slide, path, min(deg) AS deg, any_value(kind) AS was FROM al GROUP BY ALL""")
def damage_delete(m):
    return D.delete(m["shapes_gt"], steps(m, "qty % 6 = 0"))[1].select("deck", "slide", "path", "deg", "was")


@query("damage_scatter", "K2", "SELECT deck, count(*) AS n, true AS bounded FROM shapes_gt WHERE qty % 7 = 0 GROUP BY deck")
def damage_scatter(m):
    out, _ = D.scatter(m["shapes_gt"], steps(m, "qty % 7 = 0"), 1.5, 11)
    moved = out.select("deck", "slide", "path", F.col("cx").alias("nx"), F.col("cy").alias("ny")).join(m["shapes_gt"].where("qty % 7 = 0"), ["deck", "slide", "path"])
    ok = (F.abs(F.col("nx") - F.col("cx")) <= 1371600) & (F.abs(F.col("ny") - F.col("cy")) <= 754380)
    return moved.groupBy("deck").agg(F.count(F.lit(1)).alias("n"), F.bool_and(ok).alias("bounded"))


@query("damage_move", "K3", log_sql("move", "qty % 5 = 0", cx="cx + 457200", cy="cy + CASE WHEN ln % 2 = 0 THEN 228600 ELSE 0 END"))
def damage_move(m):
    return D.edit(m["shapes_gt"], steps(m, "qty % 5 = 0", dx_in=0.5, dy_in="CASE WHEN ln % 2 = 0 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"), "move")[1]


@query("damage_resize", "K4", log_sql("resize", "qty % 4 = 0", w="floor(w * 1.3::DOUBLE)::BIGINT", h="floor(h * 1.3::DOUBLE)::BIGINT",
       cx="CASE WHEN ln % 2 = 0 THEN cx ELSE cx + (floor(w * 1.3::DOUBLE)::BIGINT - w) // 2 END", cy="CASE WHEN ln % 2 = 0 THEN cy ELSE cy + (floor(h * 1.3::DOUBLE)::BIGINT - h) // 2 END"))
def damage_resize(m):
    return D.edit(m["shapes_gt"], steps(m, "qty % 4 = 0", factor=1.3, keep_centre="ln % 2 = 0"), "resize")[1]


@query("damage_swap", "K5", "WITH p AS (SELECT a.deck, a.slide, a.path, b.path AS other, 'd' || (a.ln % 5 + 1) AS deg, a.cx, a.cy, b.cx AS ox, b.cy AS oy FROM shapes_gt a JOIN shapes_gt b ON b.deck = a.deck AND b.slide = a.slide AND b.rn = a.rn + 1 WHERE a.rn % 10 = 4), e AS (SELECT deck, slide, path, deg, cx, cy, ox, oy FROM p UNION ALL SELECT deck, slide, other, deg, ox, oy, cx, cy FROM p) SELECT deck, slide, path, 'swap' AS op, deg, 'cx' AS fact, cx::VARCHAR AS was, ox::VARCHAR AS now FROM e WHERE cx <> ox UNION ALL SELECT deck, slide, path, 'swap', deg, 'cy', cy::VARCHAR, oy::VARCHAR FROM e WHERE cy <> oy")
def damage_swap(m):
    s = m["shapes_gt"]
    nxt = s.select("deck", "slide", (F.col("rn") - 1).alias("rn"), F.col("path").alias("other"))
    pairs = s.where("rn % 10 = 4").join(nxt, ["deck", "slide", "rn"]).select(
        "deck", "slide", "path", "other", F.concat(F.lit("d"), (F.col("ln") % 5 + 1).cast("string")).alias("deg"))
    return D.swap(s, pairs)[1]


@query("damage_clear_text", "K6", "WITH hit AS (SELECT deck, slide, path, ln, " + _DEG + ", regexp_replace(plain, '^(\\S+) ', '\\1' || chr(10)) AS plain FROM shapes_gt WHERE qty % 3 = 0) "
       + _LOG.format(op="clear_text", f="plain", was="plain", now="(CASE WHEN ln % 2 = 0 THEN string_split(plain, chr(10))[1] ELSE '' END)"))
def damage_clear_text(m):
    shapes = m["shapes_gt"].withColumn("plain", F.regexp_replace("plain", r"^(\S+) ", "$1\n"))
    return D.edit(shapes, steps(m, "qty % 3 = 0", keep_first="ln % 2 = 0"), "clear_text")[1]


@query("damage_set_text", "K7", log_sql("set_text", "qty % 3 = 1", plain="'text ' || ln"))
def damage_set_text(m):
    return D.edit(m["shapes_gt"], steps(m, "qty % 3 = 1", text="concat('text ', CAST(ln AS STRING))"), "set_text")[1]


@query("damage_set_font", "K8", log_sql("set_font", "qty % 3 = 2", font="CASE WHEN ln % 2 = 0 THEN 'Arial' ELSE font END", sz="CASE WHEN ln % 3 = 0 THEN 1400 ELSE sz END", bold="false"))
def damage_set_font(m):
    return D.edit(m["shapes_gt"], steps(m, "qty % 3 = 2", new_font="CASE WHEN ln % 2 = 0 THEN 'Arial' END", new_sz="CASE WHEN ln % 3 = 0 THEN CAST(1400 AS BIGINT) END", new_bold=False), "set_font")[1]


@query("damage_strip_effects", "K9", log_sql("strip_effects", "qty % 2 = 0", effects="NULL"))
def damage_strip_effects(m):
    return D.edit(m["shapes_gt"], steps(m, "qty % 2 = 0"), "strip_effects")[1]


@query("damage_drop_equation", "K10", "WITH hit AS (SELECT *, " + _DEG + ", CASE WHEN pk % 5 = 1 THEN 'frac' END AS equation FROM shapes_gt WHERE qty % 2 = 0) " + _LOG.format(op="drop_equation", f="equation", was="equation", now="NULL"))
def damage_drop_equation(m):
    shapes = m["shapes_gt"].withColumn("equation", F.when(F.col("pk") % 5 == 1, "frac"))
    return D.drop_value(shapes, steps(m, "qty % 2 = 0"), "drop_equation", "equation")[1]


@query("damage_recolor", "K11", log_sql("recolor", "qty % 4 = 1", fill_type="'solid'", fill_color="CASE WHEN ln % 2 = 0 THEN 'srgb:FF00FF' ELSE 'scheme:ACCENT1' END"))
def damage_recolor(m):
    return D.edit(m["shapes_gt"], steps(m, "qty % 4 = 1", color="CASE WHEN ln % 2 = 0 THEN 'srgb:FF00FF' ELSE 'scheme:ACCENT1' END"), "recolor")[1]


@query("damage_outline", "K12", log_sql("outline", "qty % 4 = 2", line_fill="'solid'", line_color="'srgb:00FF00'", line_w="ln * 6350"))
def damage_outline(m):
    return D.edit(m["shapes_gt"], steps(m, "qty % 4 = 2", color="'srgb:00FF00'", width="ln * 6350"), "outline")[1]


@query("damage_rotate", "K13", "SELECT deck, slide, path, 'd' || (ln % 5 + 1) AS deg, round(rot, 3) AS was, round((rot + ln * 75) % 360, 3) AS now FROM shapes_gt WHERE qty % 4 = 3 AND qty % 3 <> 0 AND (rot + ln * 75) % 360 <> rot")
def damage_rotate(m):
    log = D.edit(m["shapes_gt"], steps(m, "qty % 4 = 3", angle="CASE WHEN qty % 3 = 0 THEN 'x' ELSE CAST(ln * 75 AS STRING) END"), "rotate")[1]
    return log.select("deck", "slide", "path", "deg", F.round(F.col("was").cast("double"), 3).alias("was"), F.round(F.col("now").cast("double"), 3).alias("now"))


@query("damage_zorder", "K14", "WITH hit AS (SELECT *, " + _DEG + """, CASE WHEN qty % 9 = 0 THEN CASE WHEN ln % 2 = 0 THEN 'back' ELSE 'front' END END AS dir FROM shapes_gt),
q AS (SELECT *, row_number() OVER (PARTITION BY deck, slide, dir IS NULL ORDER BY deg, path) AS seq FROM hit),
n AS (SELECT *, row_number() OVER (PARTITION BY deck, slide, grp ORDER BY z, path) - 1 AS was,
      row_number() OVER (PARTITION BY deck, slide, grp ORDER BY CASE dir WHEN 'back' THEN -1 WHEN 'front' THEN 1 ELSE 0 END, CASE dir WHEN 'back' THEN -seq WHEN 'front' THEN seq END, z, path) - 1 AS now FROM q)
SELECT deck, slide, path, deg, was::VARCHAR AS was, now::VARCHAR AS now FROM n WHERE dir IS NOT NULL AND was <> now""")
def damage_zorder(m):
    return D.zorder(m["shapes_gt"], steps(m, "qty % 9 = 0", to="CASE WHEN ln % 2 = 0 THEN 'back' ELSE 'front' END"))[1].select("deck", "slide", "path", "deg", "was", "now")


@query("apply_recipe", "K3 K4 K11", """SELECT deck, slide, path, cx + 457200 + (floor(w * 1.5::DOUBLE)::BIGINT - w) // 2 + CASE WHEN ln % 2 = 0 THEN 228600 ELSE 0 END AS cx,
 floor(w * 1.5::DOUBLE)::BIGINT AS w, CASE WHEN ln % 2 = 0 THEN 'srgb:00FF00' ELSE 'srgb:FF0000' END AS fill_color FROM shapes_gt WHERE qty % 5 = 0""")
def apply_recipe(m):
    """Three to five steps on one shape: the later colour wins, moves add up, the table keeps its rows."""
    def ask(number, cond, op, **params):
        return steps(m, cond, step_no=number, op="'" + op + "'", **params)

    recipe = (ask(1, "qty % 5 = 0", "move", dx_in=0.5, dy_in=0.0)
              .unionByName(ask(2, "qty % 5 = 0", "recolor", color="'srgb:FF0000'"), allowMissingColumns=True)
              .unionByName(ask(3, "qty % 5 = 0", "resize", factor=1.5, keep_centre=False), allowMissingColumns=True)
              .unionByName(ask(4, "qty % 5 = 0 AND ln % 2 = 0", "move", dx_in=0.25, dy_in=0.0), allowMissingColumns=True)
              .unionByName(ask(5, "qty % 5 = 0 AND ln % 2 = 0", "recolor", color="'srgb:00FF00'"), allowMissingColumns=True))
    return D.apply_recipe(m["shapes_gt"], recipe)[0].where("qty % 5 = 0").select("deck", "slide", "path", "cx", "w", "fill_color")


@query("damage_ungroup", "K15", "SELECT k.deck, k.slide, k.path, 'd' || (g.ln % 5 + 1) AS deg, k.grp AS was FROM shapes_gt k JOIN shapes_gt g ON g.deck = k.deck AND g.slide = k.slide AND g.path = k.grp WHERE g.qty % 2 = 1")
def damage_ungroup(m):
    return D.ungroup(m["shapes_gt"], steps(m, "kind = 'group' AND qty % 2 = 1"))[1].select("deck", "slide", "path", "deg", "was")


@query("damage_clear_cells", "K16", "SELECT deck, slide, path, r, c, text AS was FROM cells WHERE text <> '' AND qty % 3 = 0 AND (r = 1 OR ln % 2 = 0) AND c <> 0 AND (c = 1 OR ln % 2 = 1)")
def damage_clear_cells(m):
    ask = steps(m, "kind = 'table' AND qty % 3 = 0", row="CASE WHEN ln % 2 = 1 THEN CAST(1 AS BIGINT) END", col="CAST(1 AS BIGINT)").unionByName(
        steps(m, "kind = 'table' AND qty % 3 = 0 AND ln % 2 = 1", row="CAST(1 AS BIGINT)", col="CAST(2 AS BIGINT)"))
    return D.clear_cells(m["cells"], ask)[1].select("deck", "slide", "path", "r", "c", "was")


@query("damage_drop_rows", "K17", "SELECT deck, slide, path, r - CASE WHEN r > 1 AND qty % 4 = 0 THEN 1 ELSE 0 END AS r, c, text FROM cells WHERE NOT (qty % 4 = 0 AND r = 1)")
def damage_drop_rows(m):
    return D.drop_lines(m["cells"], steps(m, "kind = 'table' AND qty % 4 = 0", no="CAST(1 AS BIGINT)"), "r")[0].select("deck", "slide", "path", "r", "c", "text")


@query("damage_text_runs", "K18", "WITH p AS (SELECT doc_id, para, string_agg(t, ' ' ORDER BY run) AS txt, count(*) OVER (PARTITION BY doc_id) AS paras FROM word_runs GROUP BY doc_id, para) SELECT doc_id, para, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN paras = 1 THEN 'emptied' ELSE 'deleted' END ELSE 'restyled' END AS action FROM p WHERE (doc_id % 2 = 0 AND para = 1) OR (doc_id % 2 = 1 AND contains(txt, 'an'))")
def damage_text_runs(m):
    runs = runs_by_document(m)
    ask = m["documents"].selectExpr("doc_id", "CASE WHEN doc_id % 2 = 0 THEN CAST(1 AS BIGINT) END AS para", "'an' AS phrase",
                                    "CASE WHEN doc_id % 3 = 0 THEN 'deleted' ELSE 'restyled' END AS action", "'Arial' AS new_font")
    return D.text_runs(runs, ask, ["doc_id"])[1].select("doc_id", "para", "action")


@query("damage_detach", "K19", log_sql("detach_connector", "kind = 'connector' AND qty % 2 = 0", start_id="NULL", end_id="NULL", cx="cx + 365760"))
def damage_detach(m):
    return D.detach(m["shapes_gt"], steps(m, "kind = 'connector' AND qty % 2 = 0"))[1]


@query("damage_crop", "K20", log_sql("crop", "kind = 'picture'", crop="CASE WHEN qty % 2 = 0 THEN '5,5,5,5' END"))
def damage_crop(m):
    return D.edit(m["shapes_gt"], steps(m, "kind = 'picture'", new_crop="CASE WHEN qty % 2 = 0 THEN '5,5,5,5' END"), "crop")[1]


@query("damage_drop_steps", "K21", "WITH l AS (SELECT *, slide % 4 = 0 AND step = 1 OR slide = 6 AS gone FROM anim_effects) SELECT deck, slide, dense_rank() OVER (PARTITION BY deck, slide ORDER BY step) - 1 AS step, eff FROM l WHERE NOT gone")
def damage_drop_steps(m):
    pages = m["anim_effects"].select("deck", "slide").distinct()
    ask = pages.where("slide % 4 = 0").withColumn("step_no", F.lit(2).cast("long")).unionByName(
        pages.where("slide = 6").withColumn("step_no", F.lit(None).cast("long")))
    return D.drop_steps(m["anim_effects"], ask)[0].select("deck", "slide", "step", "eff")


@query("damage_strip_transition", "K22", "SELECT deck, slide, 'fade' AS was FROM (SELECT DISTINCT deck, slide FROM shapes_gt) WHERE slide % 3 = 0 AND slide % 2 = 0")
def damage_strip_transition(m):
    pages = m["shapes_gt"].select("deck", "slide").distinct().withColumn("path", F.lit("")).withColumn("transition", F.when(F.col("slide") % 2 == 0, "fade"))
    ask = pages.where("slide % 3 = 0").select("deck", "slide", "path", F.lit("d1").alias("deg"))
    return D.drop_value(pages, ask, "strip_transition", "transition")[1].select("deck", "slide", "was")


@query("damage_blank_slide", "K23", "SELECT deck, slide, count(*) AS gone FROM shapes_gt WHERE slide = 3 AND deckno % 2 = 0 GROUP BY ALL")
def damage_blank_slide(m):
    pages = m["shapes_gt"].where("slide = 3 AND deckno % 2 = 0").select("deck", "slide").distinct().withColumn("deg", F.lit("d1"))
    return D.blank_slides(m["shapes_gt"], pages)[1].groupBy("deck", "slide").agg(F.count(F.lit(1)).alias("gone"))


@query("damage_slide_edits", "K24", "WITH l AS (SELECT deck, slide - CASE WHEN slide > 7 THEN 1 ELSE 0 END AS s FROM shapes_gt WHERE slide <> 7) SELECT deck, CASE s WHEN 2 THEN 5 WHEN 5 THEN 2 ELSE s END AS slide, count(*) AS n FROM l GROUP BY ALL")
def damage_slide_edits(m):
    decks = m["shapes_gt"].select("deck").distinct()
    cut = D.delete_slides(m["shapes_gt"], decks.withColumn("slide", F.lit(7).cast("long")))
    out = D.swap_slides(cut, decks.select("deck", F.lit(2).cast("long").alias("a"), F.lit(5).cast("long").alias("b")))
    return out.groupBy("deck", "slide").agg(F.count(F.lit(1)).alias("n"))


@query("damage_drop_series", "K25", "SELECT deck, slide, path, sname, count(*) AS points FROM series WHERE sname = 'S1' AND qty % 2 = 0 GROUP BY ALL")
def damage_drop_series(m):
    return D.drop_series(m["series"], steps(m, "kind = 'chart' AND qty % 2 = 0", sname="'S1'"))[1].select("deck", "slide", "path", "sname", "points")


_NOTED = "SELECT DISTINCT deck, slide, CASE WHEN slide % 5 <> 1 THEN CASE WHEN slide % 4 = 0 THEN '  ' ELSE concat(' note ', deck, ' ', CAST(slide AS STRING), ' ') END END AS notes, CASE WHEN slide % 3 = 0 THEN 'Title' ELSE 'Body' END AS layout FROM {src}"


@query("damage_clear_notes", "K24", "WITH p AS (" + _NOTED.replace("{src}", "shapes_gt").replace("STRING", "VARCHAR") + """), x AS (SELECT *, slide % 3 = 0 AND coalesce(trim(notes), '') <> '' AS hit FROM p)
SELECT deck, slide, CASE WHEN hit THEN trim(notes) END AS was, CASE WHEN hit THEN '' ELSE notes END AS notes FROM x""")
def damage_clear_notes(m):
    """Notes of every third page are cleared; what was there is logged."""
    pages = m.sql(_NOTED.replace("{src}", "{shapes_gt}"))
    left, log = D.clear_notes(pages, pages.where("slide % 3 = 0").select("deck", "slide", F.lit("d1").alias("deg")))
    return left.join(log.select("deck", "slide", "was"), ["deck", "slide"], "left").select("deck", "slide", "was", "notes")


@query("damage_layout_edit", "K24", "WITH p AS (" + _NOTED.replace("{src}", "shapes_gt").replace("STRING", "VARCHAR") + """), l AS (SELECT *, CASE WHEN slide = 0 THEN 'Title' ELSE 'Body' END AS layout FROM shapes_gt WHERE slide < 2),
u AS (SELECT deck, layout, count(*) AS affects FROM p GROUP BY ALL), g AS (SELECT * FROM l WHERE layout = 'Title' AND grp IS NULL AND pk % 3 = 0),
k AS (SELECT deck, layout, count(*) AS kept FROM l WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.deck = l.deck AND g.layout = l.layout AND (g.path = l.path OR g.path = l.grp)) GROUP BY ALL)
SELECT g.deck, g.layout, g.path, g.kind, g.name, affects, coalesce(kept, 0) AS kept FROM g JOIN u USING (deck, layout) LEFT JOIN k USING (deck, layout)""")
def damage_layout_edit(m):
    """Shapes of a layout are removed once and every page that inherits the layout is affected."""
    pages = m.sql(_NOTED.replace("{src}", "{shapes_gt}"))
    layouts = m["shapes_gt"].where("slide < 2").withColumn("layout", F.when(F.col("slide") == 0, "Title").otherwise("Body"))
    steps_ = layouts.where("layout = 'Title' AND pk % 3 = 0").select("deck", "layout", "path", F.lit("d1").alias("deg"))
    left, log = D.layout_edit(layouts, pages, steps_)
    kept = left.groupBy("deck", "layout").agg(F.count(F.lit(1)).alias("kept"))
    return log.drop("deg").join(kept, ["deck", "layout"], "left").fillna(0, ["kept"])


_DIAGRAM = "SELECT g.deck, g.slide, g.path, CAST(x.i AS BIGINT) AS node, CAST(x.i AS BIGINT) AS ord, concat('node ', CAST((g.pk + x.i * 5) % 11 AS STRING)) AS t, g.pk FROM {src} g CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) x WHERE g.kind = 'smartart'"
_LINKED = "SELECT g.deck, g.slide, g.path, CAST(x.a AS BIGINT) AS a, CAST(x.b AS BIGINT) AS b FROM {src} g CROSS JOIN (SELECT 0 AS a, 1 AS b UNION ALL SELECT 0, 2 UNION ALL SELECT 2, 3) x WHERE g.kind = 'smartart'"


@query("damage_drop_nodes", "K25", "WITH n AS (" + _DIAGRAM.replace("{src}", "shapes_gt").replace("STRING", "VARCHAR") + "), e AS (" + _LINKED.replace("{src}", "shapes_gt") + """),
g AS (SELECT deck, slide, path, node FROM n WHERE pk % 4 = node), d AS (SELECT e.*, EXISTS (SELECT 1 FROM g WHERE g.deck = e.deck AND g.slide = e.slide AND g.path = e.path AND node IN (a, b)) AS cut FROM e),
l AS (SELECT deck, slide, path, count(*) FILTER (WHERE NOT cut) AS links FROM d GROUP BY ALL), k AS (SELECT n.*, row_number() OVER (PARTITION BY deck, slide, path ORDER BY ord) - 1 AS place FROM n WHERE pk % 4 <> node)
SELECT deck, slide, path, string_agg(place::VARCHAR || ' ' || t, ',' ORDER BY place) AS nodes, any_value(links) AS links FROM k JOIN l USING (deck, slide, path) GROUP BY ALL""")
def damage_drop_nodes(m):
    """One node of every diagram goes with its connections, and the others close up."""
    nodes, links = m.sql(_DIAGRAM.replace("{src}", "{shapes_gt}")), m.sql(_LINKED.replace("{src}", "{shapes_gt}"))
    asked = nodes.where("pk % 4 = node").select("deck", "slide", "path", "t", F.lit("d1").alias("deg"))
    left, joined, _ = D.drop_nodes(nodes, links, asked)
    kept = joined.groupBy("deck", "slide", "path").agg(F.count(F.lit(1)).alias("links"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "t"))), lambda x: F.concat_ws(" ", x["ord"].cast("string"), x["t"])), ",")
    return left.groupBy("deck", "slide", "path").agg(text.alias("nodes")).join(kept, ["deck", "slide", "path"], "left").fillna(0, ["links"])


_ELEMENTS = "SELECT g.deck, g.slide, g.path, x.element, concat(x.element, ' ', CAST(g.pk AS STRING)) AS value, g.qty FROM {src} g CROSS JOIN (SELECT 'title' AS element, 1 AS k UNION ALL SELECT 'legend', 2 UNION ALL SELECT 'axis', 3) x WHERE g.kind = 'chart' AND g.pk % 4 <> x.k"


@query("damage_strip_elements", "K25", "SELECT deck, slide, path, element, value AS was FROM (" + _ELEMENTS.replace("{src}", "shapes_gt").replace("STRING", "VARCHAR") + ") WHERE (element = 'title' AND qty % 2 = 0) OR (element = 'legend' AND qty % 3 = 0)")
def damage_strip_elements(m):
    """Titles and legends are taken out of some charts; those that have none are not logged."""
    own = m.sql(_ELEMENTS.replace("{src}", "{shapes_gt}"))
    charts = steps(m, "kind = 'chart' AND qty % 2 = 0", element="'title'").unionByName(steps(m, "kind = 'chart' AND qty % 3 = 0", element="'legend'"))
    return D.strip_elements(own, charts)[1].drop("deg")
