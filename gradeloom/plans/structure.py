"""Queries over shapes, text runs, scripts and packages."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.functions import colour
from gradeloom.functions.text import short_sha256, squeeze
from gradeloom.operators import packages as K
from gradeloom.operators import structure as A
from gradeloom.plans.models import SLIDE_H, SLIDE_W
from gradeloom.plans.registry import query

SQL_KEYS = """list_filter([('ph:' || placeholder), ('pic:' || blob), CASE WHEN kind IN ('table', 'chart', 'smartart', 'graphicframe', 'ole') THEN kind END,
  CASE WHEN plain <> '' THEN 'txt:' || substr(sha256(plain), 1, 12) END, 'name:' || name,
  'geo:' || kind || ':' || round_even(w / 91440.0::DOUBLE, 0)::BIGINT || 'x' || round_even(h / 91440.0::DOUBLE, 0)::BIGINT, 'kind:' || kind], lambda k: k IS NOT NULL)"""
SQL_SEM = f"""sem AS (SELECT *, CASE WHEN kind = 'group' THEN NULL WHEN kind = 'connector' THEN CASE WHEN sqrt(w * w + h * h) >= 0.05 * sqrt({SLIDE_W}.0 * {SLIDE_W} + {SLIDE_H}.0 * {SLIDE_H}) THEN 'content' ELSE 'decorative' END
  WHEN w * h >= 0.8 * {SLIDE_W}.0 * {SLIDE_H} AND z <= 2 THEN 'background' WHEN w * h < 0.005 * {SLIDE_W}.0 * {SLIDE_H} AND plain = '' THEN 'decorative' ELSE 'content' END AS semantic FROM shapes_gt)"""


def _classified(m):
    return A.classify_semantics(m["shapes_gt"], SLIDE_W, SLIDE_H)


def _content(m):
    return _classified(m).where((F.col("semantic") == "content") & (F.col("kind") != "group"))


@query("squeeze_text", "A1", "SELECT doc_id, length(trim(regexp_replace(text, '\\s+', ' ', 'g')))::BIGINT AS n, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS digest FROM documents")
def squeeze_text(m):
    clean = squeeze(F.col("text"))
    return m["documents"].select("doc_id", F.length(clean).cast("long").alias("n"), F.md5(clean).alias("digest"))


@query("content_digest", "A2", "SELECT doc_id, substr(sha256(text), 1, 16) AS d16, substr(sha256(text), 1, 12) AS d12 FROM documents")
def content_digest(m):
    return m["documents"].select("doc_id", short_sha256(F.col("text")).alias("d16"), short_sha256(F.col("text"), 12).alias("d12"))


@query("identity_keys", "A3", "SELECT deck, slide, path, array_to_string(" + SQL_KEYS + ", ' | ') AS keys FROM shapes_gt")
def identity_keys(m):
    return m["shapes_gt"].select("deck", "slide", "path", F.concat_ws(" | ", A.identity_keys()).alias("keys"))


@query("number_keys", "A4", "WITH k AS (SELECT *, " + SQL_KEYS + "[1] AS key FROM shapes_gt) SELECT deck, slide, path, key, row_number() OVER (PARTITION BY deck, slide, key ORDER BY z, path) - 1 AS nth FROM k")
def number_keys(m):
    keyed = m["shapes_gt"].withColumn("key", F.element_at(A.identity_keys(), 1))
    return A.number_keys(keyed).select("deck", "slide", "path", "key", F.col("nth").cast("long").alias("nth"))


_FACTS = ("plain", "blob", "cx", "w", "fill_color", "effects", "hidden")
_UNPIVOT = " UNION ALL ".join(f"SELECT deck, slide, path, '{f}' AS fact, {f}::VARCHAR AS value FROM {{t}} WHERE {f} IS NOT NULL" for f in _FACTS)


@query("flatten_facts", "A5", "WITH f AS (" + _UNPIVOT.format(t="shapes_gt") + ") SELECT deck, fact, count(*) AS n, count(DISTINCT value) AS vals FROM f GROUP BY ALL")
def flatten_facts(m):
    flat = A.flatten_facts(m["shapes_gt"], ["deck", "slide", "path"], _FACTS)
    return flat.groupBy("deck", "fact").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("value").alias("vals"))


@query("snapshot_diff", "A6", "WITH a AS (" + _UNPIVOT.format(t="shapes_gt") + "), b AS (" + _UNPIVOT.format(t="shapes_input") + """)
SELECT deck, slide, path, fact, a.value AS was, b.value AS now FROM a FULL JOIN b USING (deck, slide, path, fact) WHERE a.value IS DISTINCT FROM b.value""")
def snapshot_diff(m):
    return A.snapshot_diff(m["shapes_gt"], m["shapes_input"], ["deck", "slide", "path"], _FACTS)


@query("semantic_class", "A8", "WITH " + SQL_SEM + "SELECT deck, slide, path, semantic FROM sem")
def semantic_class(m):
    return _classified(m).select("deck", "slide", "path", "semantic")


SQL_ALIGN = SQL_SEM + """,
ax AS (SELECT deck, slide, path, z, 'left' AS axis, cx - w / 2.0 AS pos, cy AS across FROM sem WHERE semantic = 'content' UNION ALL SELECT deck, slide, path, z, 'cx', cx, cy FROM sem WHERE semantic = 'content'
  UNION ALL SELECT deck, slide, path, z, 'right', cx + w / 2.0, cy FROM sem WHERE semantic = 'content' UNION ALL SELECT deck, slide, path, z, 'top', cy - h / 2.0, cx FROM sem WHERE semantic = 'content'
  UNION ALL SELECT deck, slide, path, z, 'cy', cy, cx FROM sem WHERE semantic = 'content' UNION ALL SELECT deck, slide, path, z, 'bottom', cy + h / 2.0, cx FROM sem WHERE semantic = 'content'),
br AS (SELECT *, CASE WHEN pos - lag(pos) OVER w > 27432 THEN 1 ELSE 0 END AS b, row_number() OVER w AS seat FROM ax WINDOW w AS (PARTITION BY deck, slide, axis ORDER BY pos, z, path)),
rn AS (SELECT *, sum(b) OVER (PARTITION BY deck, slide, axis ORDER BY seat) AS run FROM br),
gp AS (SELECT deck, slide, axis, run, count(*) AS members, string_agg(path, ',' ORDER BY seat) AS who FROM rn GROUP BY ALL HAVING count(*) >= 3),
gaps AS (SELECT rn.*, across - lag(across) OVER (PARTITION BY deck, slide, axis, run ORDER BY across, path) AS gap FROM rn),
sp AS (SELECT deck, slide, axis, run, stddev_pop(gap) AS sd, avg(gap) AS mean FROM gaps GROUP BY ALL),
grp2 AS (SELECT gp.*, sd <= 45720 AND mean > 0 AS equal_spacing FROM gp JOIN sp USING (deck, slide, axis, run))
"""


@query("alignment_runs", "A9", "WITH " + SQL_ALIGN + "SELECT deck, slide, axis, run::BIGINT AS run, members FROM grp2")
def alignment_runs(m):
    groups = A.alignment_groups(A.alignment_members(_content(m)))
    return groups.select("deck", "slide", "axis", F.col("run").cast("long").alias("run"), "members")


@query("equal_spacing", "A10", "WITH " + SQL_ALIGN + "SELECT deck, axis, count(*) AS groups, count(*) FILTER (WHERE equal_spacing) AS equal FROM grp2 GROUP BY ALL")
def equal_spacing(m):
    groups = A.alignment_groups(A.alignment_members(_content(m)))
    return groups.groupBy("deck", "axis").agg(F.count(F.lit(1)).alias("groups"), F.count_if("equal_spacing").alias("equal"))


@query("alignment_digest", "A11", "WITH " + SQL_ALIGN + """,
o AS (SELECT *, list_position(['left','cx','right','top','cy','bottom'], axis) AS ano FROM grp2),
d AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY deck, slide, who ORDER BY ano, run) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY deck, slide ORDER BY members DESC, ano, run) AS place, count(*) OVER (PARTITION BY deck, slide) AS k FROM d)
SELECT deck, slide, place, axis, members, equal_spacing, greatest(k - 10, 0)::BIGINT AS more FROM r WHERE place <= 10""")
def alignment_digest(m):
    groups = A.alignment_groups(A.alignment_members(_content(m)))
    out = A.alignment_digest(groups)
    return out.withColumn("place", F.col("place").cast("long")).withColumn("more", F.col("more").cast("long"))


@query("look_alike_clusters", "A12", "WITH " + SQL_SEM + f""",
s AS (SELECT *, round_even(w / 914400.0::DOUBLE, 1)::DOUBLE AS s_w, round_even(h / 914400.0::DOUBLE, 1)::DOUBLE AS s_h, round_even(coalesce(line_w, 0) / 6350.0::DOUBLE, 0) AS s_line FROM sem WHERE kind <> 'group' AND semantic IS DISTINCT FROM 'background'),
n AS (SELECT *, row_number() OVER (PARTITION BY deck, slide, kind, geom, s_w, s_h, fill_type, fill_color, line_color, s_line, effects ORDER BY z, path) AS seat FROM s)
SELECT deck, slide, kind, count(*) AS n, s_w, s_h, CASE WHEN (max(cx) - min(cx)) / {SLIDE_W}.0 < 0.06 THEN 'single column' WHEN (max(cy) - min(cy)) / {SLIDE_H}.0 < 0.06 THEN 'single row' ELSE 'scattered' END AS arrangement,
 string_agg(path, ',' ORDER BY seat) FILTER (WHERE seat <= 12) AS members, greatest(count(*) - 12, 0)::BIGINT AS more
FROM n GROUP BY deck, slide, kind, geom, s_w, s_h, fill_type, fill_color, line_color, s_line, effects HAVING count(*) >= 2""")
def look_alike_clusters(m):
    out = A.clusters(_classified(m), SLIDE_W, SLIDE_H)
    return out.withColumn("more", F.col("more").cast("long"))


@query("visual_system", "A13", """
WITH f AS (SELECT deck, slide, 'fill' AS facet, fill_color AS value, 6 AS cap FROM shapes_gt UNION ALL SELECT deck, slide, 'line', line_color, 4 FROM shapes_gt
 UNION ALL SELECT deck, slide, 'line_pt', round_even(line_w / 12700.0::DOUBLE, 1)::DOUBLE::VARCHAR, 4 FROM shapes_gt UNION ALL SELECT deck, slide, 'geometry', geom, 6 FROM shapes_gt
 UNION ALL SELECT deck, slide, 'effect', effects, 5 FROM shapes_gt UNION ALL SELECT deck, slide, 'font', CASE WHEN plain <> '' THEN font END, 5 FROM shapes_gt UNION ALL SELECT deck, slide, 'size', CASE WHEN plain <> '' THEN sz END::VARCHAR, 8 FROM shapes_gt),
c AS (SELECT deck, slide, facet, value, cap, count(*) AS n FROM f WHERE value IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY deck, slide, facet ORDER BY n DESC, value) AS place FROM c)
SELECT deck, slide, facet, value, n, place FROM r WHERE place <= cap""")
def visual_system(m):
    return A.visual_system(m["shapes_gt"]).withColumn("place", F.col("place").cast("long"))


@query("whole_objects", "A14", f"""
WITH c AS (SELECT deck, slide, path, string_agg(text, '|' ORDER BY r, c, text) AS cells FROM cells GROUP BY ALL),
s AS (SELECT deck, slide, path, string_agg(val::VARCHAR, '|' ORDER BY sno, i) AS points FROM series GROUP BY ALL),
k AS (SELECT deck, slide, grp AS path, count(*) AS children, string_agg(path, '|' ORDER BY z) AS kids FROM shapes_gt WHERE grp IS NOT NULL GROUP BY ALL)
SELECT deck, slide, path, kind, round_even(cx / {SLIDE_W}.0::DOUBLE, 2)::DOUBLE AS at_x, round_even(cy / {SLIDE_H}.0::DOUBLE, 2)::DOUBLE AS at_y, coalesce(children, 0) AS children, coalesce(cells, '') AS cells, coalesce(points, '') AS points, coalesce(kids, '') AS kids
FROM shapes_gt LEFT JOIN c USING (deck, slide, path) LEFT JOIN s USING (deck, slide, path) LEFT JOIN k USING (deck, slide, path) WHERE kind IN ('chart', 'table', 'picture', 'smartart', 'group')""")
def whole_objects(m):
    return A.whole_objects(m["shapes_gt"], m["cells"], m["series"], SLIDE_W, SLIDE_H)


_CONN = """
l AS (SELECT c.*, round_even(round_even(sqrt(c.w * c.w + c.h * c.h) / 914400.0, 2), 1)::DOUBLE AS len_in, round_even(c.line_w / 12700.0::DOUBLE, 1)::DOUBLE AS w_pt, c.start_id IS NOT NULL OR c.end_id IS NOT NULL AS attached, a.path AS from_path, b.path AS to_path
 FROM (SELECT * REPLACE (CASE WHEN slide % 4 = 0 THEN NULL ELSE start_id END AS start_id, CASE WHEN slide % 4 = 0 THEN NULL ELSE end_id END AS end_id) FROM shapes_gt WHERE kind = 'connector') c
 LEFT JOIN shapes_gt a ON a.deck = c.deck AND a.slide = c.slide AND a.shape_id = c.start_id LEFT JOIN shapes_gt b ON b.deck = c.deck AND b.slide = c.slide AND b.shape_id = c.end_id),
n AS (SELECT *, count(*) OVER (PARTITION BY deck, slide, geom, w_pt, len_in, attached) AS n FROM l)
"""


@query("connector_topology", "A15", "WITH " + _CONN + "SELECT deck, slide, path, attached, from_path, to_path, len_in FROM n WHERE attached OR n < 3 UNION ALL SELECT deck, slide, 'cluster of ' || n || ' from ' || min(path), false, NULL, NULL, len_in FROM n WHERE NOT attached AND n >= 3 GROUP BY deck, slide, geom, w_pt, len_in, n")
def connector_topology(m):
    loose = F.col("slide") % 4 == 0
    shapes = m["shapes_gt"].withColumn("start_id", F.when(~loose, F.col("start_id"))).withColumn("end_id", F.when(~loose, F.col("end_id")))
    rows, grouped = A.connectors(shapes)
    text = F.concat(F.lit("cluster of "), F.col("n").cast("string"), F.lit(" from "), F.col("first_path"))
    none = F.lit(None).cast("string")
    return rows.unionByName(grouped.select("deck", "slide", text.alias("path"), F.lit(False).alias("attached"),
                                           none.alias("from_path"), none.alias("to_path"), "len_in"))


@query("overlap_pairs", "A16", "WITH " + SQL_SEM + """,
b AS (SELECT deck, slide, path, z, cx - w / 2.0 AS x0, cy - h / 2.0 AS y0, cx + w / 2.0 AS x1, cy + h / 2.0 AS y1 FROM sem WHERE semantic = 'content' AND w > 0 AND h > 0),
p AS (SELECT a.deck, a.slide, a.path AS under, b.path AS over, (least(a.x1, b.x1) - greatest(a.x0, b.x0))::DOUBLE AS ox, (least(a.y1, b.y1) - greatest(a.y0, b.y0))::DOUBLE AS oy,
   least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0))::DOUBLE AS sm FROM b a JOIN b ON a.deck = b.deck AND a.slide = b.slide AND (a.z < b.z OR (a.z = b.z AND a.path < b.path))),
r AS (SELECT *, row_number() OVER (PARTITION BY deck, slide ORDER BY ox * oy / sm DESC, under, over) AS place FROM p WHERE ox > 0 AND oy > 0 AND ox * oy / sm >= 0.35)
SELECT deck, slide, under, over, round_even(ox * oy / sm, 2)::DOUBLE AS share, place FROM r WHERE place <= 10""")
def overlap_pairs(m):
    return A.top_overlaps(A.overlap_pairs(_content(m))).withColumn("place", F.col("place").cast("long"))


@query("text_style_summary", "A17", """
SELECT doc_id, para, count(*) AS n_runs, coalesce(string_agg(DISTINCT font, ',' ORDER BY font), '') AS fonts, string_agg(DISTINCT sz::VARCHAR, ',' ORDER BY sz::VARCHAR) AS sizes, coalesce(string_agg(DISTINCT color, ',' ORDER BY color), '') AS colors,
 count(*) FILTER (WHERE b) AS bold, count(*) FILTER (WHERE i) AS italic, count(*) FILTER (WHERE link) AS links FROM word_runs WHERE trim(t) <> '' GROUP BY doc_id, para""")
def text_style_summary(m):
    return A.text_summary(m["word_runs"], ["doc_id", "para"])


@query("merge_runs", "A18", """
WITH c AS (SELECT *, CASE WHEN font IS NOT DISTINCT FROM lag(font) OVER w AND b IS NOT DISTINCT FROM lag(b) OVER w AND run > 0 THEN 0 ELSE 1 END AS new FROM word_runs WINDOW w AS (PARTITION BY doc_id, para ORDER BY run)),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, para ORDER BY run) AS span FROM c)
SELECT doc_id, para, span::BIGINT AS span, string_agg(t, ' ' ORDER BY run) AS t, min(font) AS font, bool_and(b) AS b FROM g GROUP BY doc_id, para, span""")
def merge_runs(m):
    return A.merge_runs(m["word_runs"], ["doc_id", "para"], ["font", "b"]).withColumn("span", F.col("span").cast("long"))


@query("render_resolution", "A19", "SELECT doc_id, min(sz) FILTER (WHERE sz > 0) AS smallest, CASE WHEN min(sz) FILTER (WHERE sz > 0) >= 8 THEN 96 ELSE 110 END::BIGINT AS dpi FROM word_runs GROUP BY doc_id")
def render_resolution(m):
    return A.render_class(m["word_runs"], ["doc_id"])


_COLOURS = """SELECT p_partkey AS id, upper(substr(md5(p_name), 1, 6)) AS hex, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE upper(substr(md5(p_brand), 1, 6)) END AS other,
  CASE WHEN p_partkey % 3 = 1 THEN 40000 + p_partkey % 60000 END AS lum_mod, CASE WHEN p_partkey % 6 = 1 THEN p_partkey % 50000 END AS lum_off,
  CASE WHEN p_partkey % 4 = 2 THEN 75000 END AS shade, CASE WHEN p_partkey % 7 = 3 THEN 60000 END AS tint FROM {src}"""
_HEX = "('0x' || substr({c}, {i}, 2))::INT::DOUBLE"
_RGB = "p AS (SELECT *, " + ", ".join(_HEX.format(c="hex", i=i) + f" AS {n}" for n, i in (("r", 1), ("g", 3), ("b", 5))) + ", " + ", ".join(_HEX.format(c="other", i=i) + f" AS q{n}" for n, i in (("r", 1), ("g", 3), ("b", 5))) + " FROM c)"
_BACK = "CASE WHEN s = 0 THEN l2 WHEN {x} < 1.0/6 THEN lo + (up - lo) * {x} * 6 WHEN {x} < 0.5 THEN up WHEN {x} < 2.0/3 THEN lo + (up - lo) * (2.0/3 - {x}) * 6 ELSE lo END"
_TURN = "((h{t}) - floor(h{t}))"


@query("resolve_colour", "A20", "WITH c AS (" + _COLOURS.replace("{src}", "part") + "), " + _RGB + """,
q AS (SELECT *, greatest(r, g, b) / 255 AS mx, least(r, g, b) / 255 AS mn FROM p),
hls AS (SELECT *, (mx + mn) / 2 AS l, CASE WHEN mx = mn THEN 0 WHEN (mx + mn) / 2 <= 0.5 THEN (mx - mn) / (mx + mn) ELSE (mx - mn) / (2 - mx - mn) END AS s,
  CASE WHEN mx = mn THEN 0 WHEN r / 255 = mx THEN (g - b) / 255 / (mx - mn) / 6 WHEN g / 255 = mx THEN (2 + (b - r) / 255 / (mx - mn)) / 6 ELSE (4 + (r - g) / 255 / (mx - mn)) / 6 END AS h0 FROM q),
m1 AS (SELECT *, h0 - floor(h0) AS h, l * coalesce(lum_mod, 100000) / 100000.0 AS la FROM hls),
m2 AS (SELECT *, CASE WHEN lum_off IS NOT NULL THEN least(1.0, la + lum_off / 100000.0) ELSE la END * coalesce(shade, 100000) / 100000.0 AS lb FROM m1),
m3 AS (SELECT *, greatest(0.0, least(1.0, CASE WHEN tint IS NOT NULL THEN lb * 0.6 + 0.4 ELSE lb END)) AS l2 FROM m2),
m4 AS (SELECT *, CASE WHEN l2 <= 0.5 THEN l2 * (1 + s) ELSE l2 + s - l2 * s END AS up FROM m3), m5 AS (SELECT *, 2 * l2 - up AS lo FROM m4),
o AS (SELECT *, """ + ", ".join("abs(round_even((" + _BACK.format(x=_TURN.format(t=t)) + f")::DOUBLE * 255, 0) - {n}) AS d_{n}" for n, t in (("r", " + 1.0/3"), ("g", ""), ("b", " - 1.0/3"))) + """ FROM m5)
SELECT id, lum_mod IS NOT NULL OR lum_off IS NOT NULL OR shade IS NOT NULL OR tint IS NOT NULL AS modified,
 CASE WHEN lum_mod IS NOT NULL OR lum_off IS NOT NULL OR shade IS NOT NULL OR tint IS NOT NULL THEN floor((d_r + d_g + d_b) / 12)::BIGINT ELSE 0 END AS shift_step FROM o""")
def resolve_colour(m):
    """Resolved channels after luminance changes, reported as the size of the shift."""
    rows = m.sql(_COLOURS.replace("{src}", "{part}")).withColumn("rgb", colour.rgb_of(F.col("hex")))
    rows = colour.with_luminance(rows, "rgb", "new")
    shift = sum((F.abs(F.col(f"new.{c}") - F.col(f"rgb.{c}")) for c in "rgb"), F.lit(0.0))
    changed = F.coalesce("lum_mod", "lum_off", "shade", "tint").isNotNull()
    return rows.select("id", changed.alias("modified"), F.floor(shift / 12).cast("long").alias("shift_step"))


def _sql_lab(prefix: str) -> str:
    def lin(c: str) -> str:
        return f"(CASE WHEN {c} / 255 <= 0.04045 THEN {c} / 255 / 12.92 ELSE pow(({c} / 255 + 0.055) / 1.055, 2.4) END)"

    r, g, b = (lin(prefix + c) for c in "rgb")
    return (f"(0.4124 * {r} + 0.3576 * {g} + 0.1805 * {b}) / 0.95047 AS {prefix}X, 0.2126 * {r} + 0.7152 * {g} + 0.0722 * {b} AS {prefix}Y, "
            f"(0.0193 * {r} + 0.1192 * {g} + 0.9505 * {b}) / 1.08883 AS {prefix}Z")


def _sql_f(t: str) -> str:
    return f"(CASE WHEN {t} > 0.008856 THEN pow({t}, 1.0::DOUBLE / 3) ELSE 7.787 * {t} + 16.0::DOUBLE / 116 END)"


@query("colour_distance", "A21", "WITH c AS (" + _COLOURS.replace("{src}", "part") + "), " + _RGB + ", x AS (SELECT *, " + _sql_lab("") + ", " + _sql_lab("q") + " FROM p)" + f"""
SELECT id, CASE WHEN other IS NULL THEN 100.0 ELSE round(sqrt(pow(116 * ({_sql_f('Y')} - {_sql_f('qY')}), 2) + pow(500 * (({_sql_f('X')} - {_sql_f('Y')}) - ({_sql_f('qX')} - {_sql_f('qY')})), 2)
  + pow(200 * (({_sql_f('Y')} - {_sql_f('Z')}) - ({_sql_f('qY')} - {_sql_f('qZ')})), 2)), 4) END::DOUBLE AS delta_e FROM x""")
def colour_distance(m):
    rows = m.sql(_COLOURS.replace("{src}", "{part}"))
    rows = colour.with_delta_e(rows, colour.rgb_of(F.col("hex")), colour.rgb_of(F.col("other")), "gap")
    return rows.select("id", F.round("gap", 4).alias("delta_e"))


@query("style_features", "A22", """
SELECT deck, slide, path, (CASE WHEN effects IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN line_fill IS NOT NULL AND (coalesce(line_dash <> 'solid', false) OR coalesce(line_w, 0) > 19050) THEN 1 ELSE 0 END
 + CASE WHEN coalesce(geom, 'rect') <> 'rect' THEN 1 ELSE 0 END)::BIGINT AS features FROM shapes_gt""")
def style_features(m):
    return m["shapes_gt"].select("deck", "slide", "path", A.style_features().alias("features"))


_THEMES = """SELECT deck, @PICK(@ARRAY('dk1', 'lt1', 'dk2', 'lt2', 'accent1', 'tx2'), CAST(rn % 6 + 1 AS INT)) AS name,
  CASE WHEN (deckno + rn % 6) % 4 = 0 AND rn = 7 THEN 'ABCDEF' ELSE concat('aa00', CAST(10 + rn % 6 AS STRING)) END AS value FROM {src} WHERE (rn % 6 <> 5 OR deckno % 2 = 0)"""


@query("theme_consensus", "A23", "WITH t AS (" + _THEMES.replace("{src}", "shapes_gt").replace("@PICK(@ARRAY(", "list_extract(list_value(") + """),
a AS (SELECT deck, name, max(upper(value)) AS value FROM t GROUP BY ALL HAVING count(DISTINCT upper(value)) = 1)
SELECT * FROM a UNION ALL SELECT deck, al, value FROM a JOIN (VALUES ('dk1', 'tx1'), ('lt1', 'bg1'), ('dk2', 'tx2'), ('lt2', 'bg2')) x(nm, al) ON nm = name WHERE (deck, al) NOT IN (SELECT (deck, name) FROM a)""")
def theme_consensus(m):
    return A.theme_consensus(m.sql(_THEMES.replace("{src}", "{shapes_gt}")))


_CHARS = """
ch AS (SELECT doc_id, unnest(string_split(text, '')) AS c FROM documents),
ct AS (SELECT doc_id, unicode(c)::BIGINT AS cp, count(*) AS n FROM ch WHERE c <> '' AND NOT regexp_full_match(c, '[\\s\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]') GROUP BY ALL),
cv AS (SELECT *, (cp BETWEEN 32 AND 126 OR cp BETWEEN 192 AND 250 OR cp BETWEEN 1040 AND 1080) AS covered FROM ct)
"""
_SCRIPT = "CASE " + " ".join(f"WHEN cp BETWEEN {a} AND {b} THEN '{s}'" for a, b, s in A.SCRIPT_RANGES) + " ELSE 'Unknown' END"


def _coverage(m):
    """Coverage as fonts would state it: overlapping ranges from every nation's row."""
    return A.merge_ranges(m["nation"].selectExpr(
        "CASE n_nationkey % 3 WHEN 0 THEN 32 + n_nationkey WHEN 1 THEN 192 + n_nationkey ELSE 1040 + n_nationkey - 2 END AS lo",
        "CASE n_nationkey % 3 WHEN 0 THEN 126 WHEN 1 THEN 250 ELSE 1080 END AS hi").withColumn(
        "lo", F.when(F.col("hi") == 250, F.greatest(F.lit(192), F.col("lo") - 1)).otherwise(F.col("lo"))))


@query("script_census", "A24", "WITH " + _CHARS + f"SELECT doc_id, {_SCRIPT} AS script, sum(n)::BIGINT AS chars, count(DISTINCT cp) AS distinct_chars, sum(CASE WHEN NOT covered THEN n ELSE 0 END)::BIGINT AS uncovered FROM cv GROUP BY 1, 2")
def script_census(m):
    counts = A.char_counts(m["documents"], ["doc_id"])
    return A.script_census(A.coverage_of(counts, _coverage(m)), ["doc_id"])


@query("font_verdict", "A25", "WITH " + _CHARS + """,
sl AS (SELECT 'deck' || (doc_id % 50) AS deck, doc_id, sum(n) AS chars, sum(CASE WHEN NOT covered THEN n ELSE 0 END) AS bad FROM cv GROUP BY 1, 2),
d AS (SELECT deck, sum(chars)::BIGINT AS chars, sum(bad)::BIGINT AS uncovered, max(bad / chars) AS worst FROM sl GROUP BY deck)
SELECT deck, chars, uncovered, CASE WHEN uncovered = 0 THEN 'ok' WHEN uncovered / chars > 0.1 THEN 'unrenderable' WHEN worst > 0.1 THEN 'degraded' WHEN uncovered / chars <= 0.01 THEN 'incidental' ELSE 'degraded' END AS verdict FROM d""")
def font_verdict(m):
    covered = A.coverage_of(A.char_counts(m["documents"], ["doc_id"]), _coverage(m))
    slides = covered.groupBy(F.concat(F.lit("deck"), (F.col("doc_id") % 50).cast("string")).alias("deck"), "doc_id").agg(
        F.sum("n").alias("chars"), F.sum(F.when(~F.col("covered"), F.col("n")).otherwise(0)).alias("uncovered"))
    return A.font_verdict(slides).select("deck", "chars", "uncovered", "verdict")


@query("merge_ranges", "A26", """
WITH r AS (SELECT (p_partkey * 37) % 5000 * 3 AS lo, (p_partkey * 37) % 5000 * 3 + p_size % 5 AS hi FROM part),
m AS (SELECT lo, hi, max(hi) OVER (ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + 1 THEN 1 ELSE 0 END) OVER (ORDER BY lo, hi) AS island FROM m)
SELECT min(lo) AS lo, max(hi) AS hi FROM g GROUP BY island""")
def merge_ranges(m):
    return A.merge_ranges(m["part"].selectExpr("(p_partkey * 37) % 5000 * 3 AS lo", "(p_partkey * 37) % 5000 * 3 + p_size % 5 AS hi"))


@query("visibility_plan", "A30", """
WITH a AS (SELECT DISTINCT deck, slide, step, target, CASE WHEN cls = 'entr' THEN 'reveal' ELSE 'conceal' END AS action FROM anim_effects WHERE cls IN ('entr', 'exit')),
f AS (SELECT deck, slide, target FROM a WHERE action = 'reveal' GROUP BY ALL) SELECT a.*, f.target IS NOT NULL AS hidden_at_start FROM a LEFT JOIN f USING (deck, slide, target)""")
def visibility_plan(m):
    return A.visibility_plan(m["anim_effects"]).select("deck", "slide", "step", "target", "action", "hidden_at_start")


@query("animation_digest", "A31", "SELECT deck, slide, count(DISTINCT step) AS build_steps, count(*) AS effects, count(*) FILTER (WHERE cls = 'entr') AS entr, count(*) FILTER (WHERE cls = 'exit') AS exit, count(*) FILTER (WHERE cls = 'emph') AS emph FROM anim_effects GROUP BY ALL")
def animation_digest(m):
    return A.animation_digest(m["anim_effects"])


@query("part_categories", "A32", """
WITH c AS (SELECT deck, CASE WHEN part LIKE 'ppt/slides/slide%.xml' THEN 'slides' WHEN part LIKE 'ppt/charts/chart%.xml' THEN 'charts' WHEN contains(part, '/media/') THEN 'media' END AS category FROM parts)
SELECT deck, category, count(*) AS n FROM c WHERE category IS NOT NULL GROUP BY ALL""")
def part_categories(m):
    return K.part_categories(m["parts"])


@query("untyped_parts", "A33", """
SELECT deck, part FROM parts WHERE NOT (starts_with(part, 'ppt/slides/') AND right(deck, 1) <> '3') AND NOT (part LIKE '%.png' OR (part LIKE '%.xml' AND right(deck, 1) IN ('1', '2', '4', '6')))""")
def untyped_parts(m):
    parts = m["parts"]
    overrides = parts.where(F.col("part").startswith("ppt/slides/") & (F.right("deck", F.lit(1)) != "3")).select("deck", "part")
    decks = parts.select("deck").distinct()
    defaults = decks.withColumn("ext", F.lit("png")).unionByName(
        decks.where(F.right("deck", F.lit(1)).isin("1", "2", "4", "6")).withColumn("ext", F.lit("xml")))
    return K.untyped_parts(parts, overrides, defaults)


@query("dangling_references", "A34", """
SELECT r.deck, r.owner AS part, r.rid, 'missing part' AS problem FROM rels r WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.deck = r.deck AND p.part = r.target)
UNION ALL SELECT DISTINCT u.deck, u.part, u.rid, 'undeclared id' FROM uses u WHERE NOT EXISTS (SELECT 1 FROM rels r WHERE r.deck = u.deck AND r.owner = u.part AND r.rid = u.rid)""")
def dangling_references(m):
    return K.dangling(m["rels"], m["parts"], m["uses"])


_ORPHANS = """
rc AS (SELECT deck, target AS part FROM rels WHERE owner = '' UNION SELECT r.deck, r.target FROM rc JOIN rels r ON r.deck = rc.deck AND r.owner = rc.part),
orph AS (SELECT deck, part FROM parts p WHERE NOT EXISTS (SELECT 1 FROM rc WHERE rc.deck = p.deck AND rc.part = p.part))
"""


@query("orphan_parts", "A35", "WITH RECURSIVE " + _ORPHANS + "SELECT deck, part FROM orph")
def orphan_parts(m):
    return K.orphans(m["parts"], m["rels"])


@query("duplicate_shape_ids", "A36", "SELECT deck, slide, shape_id - CASE WHEN pk % 29 = 0 AND rn > 0 THEN 1 ELSE 0 END AS shape_id, count(*) AS uses FROM shapes_gt GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_shape_ids(m):
    shifted = m["shapes_gt"].withColumn("shape_id", F.col("shape_id") - F.when((F.col("pk") % 29 == 0) & (F.col("rn") > 0), 1).otherwise(0))
    return K.duplicate_ids(shifted)


_DEAD = """dead AS (SELECT deck, owner, rid, target FROM rels r WHERE starts_with(owner, 'ppt/slides/') AND rtype <> 'hyperlink' AND NOT EXISTS (SELECT 1 FROM uses u WHERE u.deck = r.deck AND u.part = r.owner AND u.rid = r.rid))"""


@query("dead_relations", "A37", "WITH " + _DEAD + " SELECT deck, owner, rid, target FROM dead")
def dead_relations(m):
    return K.dead_rels(m["rels"], m["uses"])


@query("answer_leaks", "A38", "WITH RECURSIVE " + _ORPHANS + "," + _DEAD + """,
rem AS (SELECT DISTINCT deck, kind FROM components WHERE op = 'delete' AND kind IN ('picture', 'chart')),
w AS (SELECT deck, kind, prefix FROM rem JOIN (VALUES ('chart', 'ppt/charts/'), ('chart', 'ppt/embeddings/'), ('picture', 'ppt/media/')) v(k, prefix) ON k = kind),
ni AS (SELECT deck, count(*) AS n FROM parts WHERE starts_with(part, 'ppt/charts/') GROUP BY 1),
ng AS (SELECT deck, count(*) AS n FROM shapes_gt WHERE kind = 'chart' AND NOT (pk % 37 = 1 AND right(deck, 1) = '5') GROUP BY 1)
SELECT deck, 'thumbnail survived' AS signal, part AS evidence FROM parts WHERE starts_with(part, 'docProps/thumbnail.')
UNION SELECT w.deck, 'nothing was removed', prefix FROM w JOIN ni USING (deck) JOIN ng ON ng.deck = w.deck WHERE prefix = 'ppt/charts/' AND ni.n >= ng.n
UNION SELECT w.deck, 'orphaned but present', o.part FROM w JOIN orph o ON o.deck = w.deck AND starts_with(o.part, prefix)
UNION SELECT w.deck, 'never drawn', d.owner || ' ' || d.rid FROM w JOIN dead d ON d.deck = w.deck AND starts_with(d.target, prefix)""")
def answer_leaks(m):
    removed = m["components"].where((F.col("op") == "delete") & F.col("kind").isin("picture", "chart"))
    gt_parts = m["shapes_gt"].where((F.col("kind") == "chart") & ~((F.col("pk") % 37 == 1) & (F.right("deck", F.lit(1)) == "5"))).select(
        "deck", F.concat(F.lit("ppt/charts/c"), F.col("slide").cast("string"), F.lit("-"), "path").alias("part"))
    return K.leak_check(removed, m["parts"], gt_parts, m["rels"], m["uses"])


@query("live_media", "A39", "SELECT deck, sha, count(*) AS copies FROM parts p WHERE EXISTS (SELECT 1 FROM rels r WHERE r.deck = p.deck AND r.target = p.part AND starts_with(r.owner, 'ppt/slides/') AND contains(r.target, 'media/')) GROUP BY ALL")
def live_media(m):
    return K.live_media(m["rels"], m["parts"])


_NESTED = """SELECT deck, slide, path, grp, CAST(cx AS DOUBLE) AS x, CAST(cy AS DOUBLE) AS y, CAST(w AS DOUBLE) AS w, CAST(h AS DOUBLE) AS h,
  CASE WHEN kind = 'group' THEN CAST(cx - 1000 AS DOUBLE) END AS ch_x, CASE WHEN kind = 'group' THEN CAST(cy + 500 AS DOUBLE) END AS ch_y,
  CASE WHEN kind = 'group' THEN CAST(w * 2 AS DOUBLE) END AS ch_w, CASE WHEN kind = 'group' THEN CAST(h * 4 AS DOUBLE) END AS ch_h FROM {src}"""


@query("page_boxes", "A40", "WITH n AS (" + _NESTED.replace("{src}", "shapes_gt") + """),
a AS (SELECT deck, slide, path, x AS px, y AS py, w AS pw, h AS ph FROM n WHERE grp IS NULL
 UNION ALL SELECT k.deck, k.slide, k.path, g.x + (k.x - g.ch_x) / 2, g.y + (k.y - g.ch_y) / 4, k.w / 2, k.h / 4 FROM n k JOIN n g ON g.deck = k.deck AND g.slide = k.slide AND g.path = k.grp)
SELECT deck, slide, path, round_even(px + pw / 2, 0)::BIGINT AS cx, round_even(py + ph / 2, 0)::BIGINT AS cy, round_even(pw, 0)::BIGINT AS w, round_even(ph, 0)::BIGINT AS h FROM a""")
def page_boxes(m):
    return A.page_boxes(m.sql(_NESTED.replace("{src}", "{shapes_gt}")))


@query("deck_summary", "A41", "WITH " + SQL_SEM + """,
r AS (SELECT *, row_number() OVER (PARTITION BY deck, slide, semantic ORDER BY w * h DESC, z, path) AS place FROM sem)
SELECT deck, count(DISTINCT slide) AS slides, count(*) FILTER (WHERE semantic = 'content') AS content, count(*) FILTER (WHERE semantic = 'decorative') AS decorative, count(*) FILTER (WHERE semantic = 'background') AS background,
 count(*) FILTER (WHERE kind = 'group') AS groups, count(*) FILTER (WHERE semantic = 'content' AND place <= 10) AS listed, count(*) FILTER (WHERE semantic = 'content' AND place > 10) AS not_listed FROM r GROUP BY deck""")
def deck_summary(m):
    return A.deck_summary(A.slide_digest(_classified(m), 10))


@query("bounded_digest", "A42")
def bounded_digest(m):
    return A.bounded_digest(_classified(m), ceiling=40000)


_WANTED = """SELECT DISTINCT deck, @PICK(@ARRAY('Calibri-Light', 'Noto Sans', 'Frutiger 55 Roman', 'SimSun', 'Helvetica Neue', 'Font 12 Bold', 'Zapf'), CAST(pk % 7 + 1 AS INT)) AS face FROM {src}"""


@query("missing_fonts", "A43", "WITH w AS (" + _WANTED.replace("{src}", "shapes_gt").replace("@PICK(@ARRAY(", "list_extract(list_value(") + ") SELECT deck, face FROM w WHERE face IN ('Frutiger 55 Roman', 'Zapf')")
def missing_fonts(m):
    installed = m["part"].select(F.concat(F.lit("Font "), F.col("p_size").cast("string")).alias("face")).distinct().unionByName(
        m["region"].select(F.when(F.col("r_regionkey") % 2 == 0, "Noto Sans CJK SC").otherwise("DejaVu Sans").alias("face")))
    return A.missing_fonts(m.sql(_WANTED.replace("{src}", "{shapes_gt}")), installed, ["calibri", "helvetica", "arial"], ["simsun"])
