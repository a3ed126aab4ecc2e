"""Queries over the corpus index, the candidate pool and registration."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import corpus as C
from gradeloom.operators import registration as G
from gradeloom.plans.registry import query
from gradeloom.sources import files as S

_VERDICT = """
verdict AS (SELECT c.*, lower(trim(license)) AS licence, p.family,
   p.ok IS NOT NULL AND p.ok AS ok, coalesce(p.family = 'share-alike', false) AS share_alike,
   CASE WHEN p.ok THEN p.family || ': derivatives and redistribution permitted'
        WHEN p.lic IS NOT NULL THEN p.reason
        ELSE 'licence id not in the reviewed list — refused pending review' END AS why
 FROM corpus_index c LEFT JOIN (VALUES ('cc-by-4.0', true, 'attribution', NULL),
   ('cc-by-sa-4.0', true, 'share-alike', NULL), ('cc-zero', true, 'public domain dedication', NULL),
   ('mit-license', true, 'permissive-oss', NULL), ('cc-by-nc-4.0', false, NULL, 'non-commercial'),
   ('cc-by-nd-4.0', false, NULL, 'no-derivatives'), ('notspecified', false, NULL, 'no licence stated'))
   p(lic, ok, family, reason) ON lower(trim(c.license)) = p.lic)
"""
_SELECTED = "WITH " + _VERDICT + """,
firsts AS (SELECT checksum, min(ord) AS f FROM verdict WHERE ok AND checksum <> '' GROUP BY checksum),
selected AS (SELECT v.*, v.ok AND (v.checksum = '' OR f.f = v.ord) AS kept,
   CASE WHEN NOT v.ok THEN 'licence: ' || why WHEN v.checksum <> '' AND f.f <> v.ord
        THEN 'duplicate of doc-' || f.f || '.pptx' END AS reason
  FROM verdict v LEFT JOIN firsts f ON v.checksum = f.checksum AND v.ok)
"""


@query("index_scan", "S1", "SELECT filename, size, url, license, title, created, updated, doi, checksum FROM corpus_index")
def index_scan(m):
    return m["corpus_index"].select(*C.INDEX_COLUMNS)


@query("licence_verdict", "C1", "WITH " + _VERDICT + "SELECT ord, licence, ok, family, share_alike, why FROM verdict")
def licence_verdict(m):
    return C.licence_verdict(m["corpus_index"]).select("ord", "licence", "ok", "family", "share_alike", "why")


@query("dedup_first", "C2", _SELECTED + "SELECT ord, kept, reason FROM selected")
def dedup_first(m):
    return C.select_rows(m["corpus_index"]).select("ord", "kept", "reason")


@query("selection_audit", "C3", _SELECTED + """,
labels AS (SELECT 'in' AS metric, 'all' AS label FROM selected
 UNION ALL SELECT 'out', 'all' FROM selected WHERE kept
 UNION ALL SELECT 'family', family FROM selected WHERE kept
 UNION ALL SELECT 'share_alike', 'all' FROM selected WHERE kept AND share_alike
 UNION ALL SELECT 'dropped', CASE WHEN reason LIKE 'duplicate of%' THEN 'duplicate' ELSE reason END FROM selected WHERE NOT kept)
SELECT metric, label, count(*) AS n FROM labels GROUP BY ALL""")
def selection_audit(m):
    return C.selection_audit(C.select_rows(m["corpus_index"]))


@query("deck_locations", "C4", """
SELECT ord, 'pptx/' || license || '/' || substr(created, 1, 4) || '/' || replace(checksum, 'md5:', '') || '-' || filename AS path,
  'https://mirror.example.org/' || replace(url_encode('pptx/' || license || '/' || substr(created, 1, 4) || '/' || replace(checksum, 'md5:', '') || '-' || filename), '%2F', '/')
    || ' ' || url AS places
FROM corpus_index""")
def deck_locations(m):
    located = C.with_locations(m["corpus_index"], "https://mirror.example.org/")
    return located.select("ord", "path", F.concat_ws(" ", "urls").alias("places"))


#: Part listings: every document's page links stand for the names in one archive.
_PARTS = """
SELECT concat('deck', CAST(deckno AS STRING)) AS deck,
  CASE kind WHEN 'picture' THEN concat('ppt/media/', blob, '.png')
    WHEN 'chart' THEN concat('ppt/charts/chart', CAST(rn AS STRING), '.xml')
    WHEN 'smartart' THEN concat('ppt/diagrams/data', CAST(rn AS STRING), '.xml')
    WHEN 'table' THEN concat('ppt/embeddings/book', CAST(rn AS STRING), '.xlsx')
    WHEN 'group' THEN concat('ppt/slides/slide', CAST(slide + 1 AS STRING), '.xml')
    WHEN 'connector' THEN concat('ppt/notesSlides/notesSlide', CAST(slide AS STRING), '.xml')
    WHEN 'placeholder' THEN concat('ppt/slideLayouts/slideLayout', CAST(rn AS STRING), '.xml')
    WHEN 'textbox' THEN concat('ppt/charts/style', CAST(rn AS STRING), '.xml')
    ELSE concat('docProps/p', CAST(rn AS STRING), '.xml') END AS part
"""


@query("shape_counts", "C5", "WITH names AS (" + _PARTS.replace("concat('deck', CAST(deckno AS STRING))", "'deck' || deckno") + """ FROM shapes_gt)
SELECT deck, count(*) FILTER (WHERE regexp_full_match(part, 'ppt/slides/slide[0-9]+\\.xml')) AS slides,
 count(*) FILTER (WHERE starts_with(part, 'ppt/media/')) AS media,
 count(*) FILTER (WHERE regexp_full_match(part, 'ppt/charts/chart[0-9]+\\.xml')) AS charts,
 count(*) FILTER (WHERE regexp_full_match(part, 'ppt/diagrams/data[0-9]+\\.xml')) AS diagrams,
 count(*) FILTER (WHERE starts_with(part, 'ppt/embeddings/')) AS embeddings,
 count(*) FILTER (WHERE starts_with(part, 'ppt/notesSlides/notesSlide')) AS notes,
 count(*) FILTER (WHERE starts_with(part, 'ppt/slideLayouts/slideLayout')) AS layouts
FROM names GROUP BY deck""")
def shape_counts(m):
    return C.shape_counts(m.sql(_PARTS + " FROM {shapes_gt}"))


@query("slide_band", "C6", "SELECT ord, pages, pages >= 5 AND pages <= 25 AS in_band FROM pool")
def slide_band(m):
    return m["pool"].select("ord", "pages", C.in_band(F.col("pages")).alias("in_band"))


@query("funnel_status", "C7", """
SELECT status, count(*) AS n, sum(size)::BIGINT AS bytes FROM (SELECT size, CASE WHEN ord % 11 = 0 THEN 'probe_failed' WHEN pages NOT BETWEEN 5 AND 25 THEN 'out_of_band'
  WHEN ord % 11 = 2 THEN 'download_failed' WHEN ord % 11 = 3 THEN 'unreadable' ELSE 'scored' END AS status FROM pool) GROUP BY status""")
def funnel_status(m):
    o = F.col("ord") % 11
    rows = m["pool"].withColumn("status", C.funnel_status(o != 0, F.col("pages"), o != 2, o != 3))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


_FLAGS = """
flags AS (SELECT *, NOT (big_picture AND content <= 2) AND content >= 4 AND hard <= 1 AS usable,
  big_picture AND content <= 2 AS pasted FROM slide_features),
rich AS (SELECT *, usable AND (aligned_groups > 0 OR charts > 0 OR tables > 0 OR diagrams > 0 OR pictures >= 2) AS rich FROM flags)
"""


@query("slide_features", "C8", "WITH " + _FLAGS + "SELECT deck, slide, content, charts, pictures, hard, pasted, usable, rich FROM rich")
def slide_features(m):
    return C.slide_features(m["slide_features"]).select(
        "deck", "slide", "content", "charts", "pictures", "hard", "pasted", "usable", "rich")


@query("triage_score", "C9", "WITH " + _FLAGS + """,
d AS (SELECT deck, count(*) AS slides, count(*) FILTER (WHERE usable) AS u, count(*) FILTER (WHERE rich) AS r,
  count(*) FILTER (WHERE pasted) AS p, sum(pictures) AS pics, sum(charts) + sum(diagrams) + count(*) FILTER (WHERE animated) AS sc
  FROM rich GROUP BY deck),
s AS (SELECT *, round_even(greatest(0, least(100, 40.0 * r / (r + 3) + 20.0 * u / slides + 25.0 * sc / (sc + 3) + 15.0 * pics / (pics + 6)
  - CASE WHEN p > slides * 0.5 THEN 40 ELSE 0 END - CASE WHEN u < 3 THEN 40 ELSE 0 END))::DOUBLE, 1) AS score FROM d)
SELECT deck, slides, u AS usable_slides, r AS rich_slides, score::DOUBLE AS score,
  CASE WHEN score >= 50 THEN 'promising' WHEN score >= 28 THEN 'marginal' ELSE 'reject' END AS verdict FROM s""")
def triage_score(m):
    scored = C.triage_score(C.slide_features(m["slide_features"]))
    return scored.select("deck", "slides", "usable_slides", "rich_slides", "score", "verdict")


@query("best_slides", "C10", "WITH " + _FLAGS + """,
v AS (SELECT deck, slide, aligned_groups * 3 + charts * 3 + diagrams * 3 + tables * 2 + pictures + content / 4.0 AS val FROM rich WHERE usable)
SELECT deck, slide, place FROM (SELECT deck, slide, row_number() OVER (PARTITION BY deck ORDER BY val DESC, slide) AS place FROM v) WHERE place <= 6""")
def best_slides(m):
    best = C.best_slides(C.slide_features(m["slide_features"]))
    return best.select("deck", "slide", F.col("place").cast("long").alias("place"))


_FAMILIES = """
fam AS (SELECT pool_key, ord, score, 'animation' AS family, 0 AS fo, animation_effects + 4 * motion_paths + 3 * interactive_triggers + 2 * transitions AS v FROM {src}
 UNION ALL SELECT pool_key, ord, score, 'equation', 1, 5 * equations FROM {src}
 UNION ALL SELECT pool_key, ord, score, 'chart', 2, 3 * charts FROM {src}
 UNION ALL SELECT pool_key, ord, score, 'effects', 3, effects FROM {src})
"""
_CAND = "cand AS (SELECT * FROM (SELECT * FROM pool QUALIFY row_number() OVER (PARTITION BY pool_key ORDER BY ord) = 1) WHERE status = 'scored' AND used_in IS NULL AND score >= 50 AND fonts_missing = '')"


@query("family_value", "C11", "WITH " + _FAMILIES.format(src="pool") + "SELECT ord, family, v::BIGINT AS family_value FROM fam")
def family_value(m):
    return C.family_value(m["pool"]).select("ord", "family", "family_value")


@query("scan_todo", "C13", _SELECTED + """
SELECT s.ord, s.filename FROM selected s WHERE s.kept AND (CASE WHEN s.checksum <> '' THEN s.checksum ELSE s.filename END)
  NOT IN (SELECT pool_key FROM pool WHERE ord % 2 = 0)""")
def scan_todo(m):
    kept = C.select_rows(m["corpus_index"]).where("kept")
    scanned = m["pool"].where(F.col("ord") % 2 == 0)
    return C.todo(kept, scanned).select("ord", "filename")


@query("stale_labels", "C14", "SELECT ord, pool_key, score FROM pool WHERE status = 'scored' AND used_in IS NULL AND score >= 50 AND triage_version <> 2")
def stale_labels(m):
    return C.stale_labels(m["pool"]).select("ord", "pool_key", "score")


@query("choose_top", "C15", "WITH " + _CAND + "SELECT ord, pool_key, score FROM cand ORDER BY score DESC, pool_key, ord LIMIT 50")
def choose_top(m):
    return C.choose(_one_per_key(m), 50).select("ord", "pool_key", "score")


_FAMS = ("animation", "equation", "chart", "effects")


@query("choose_balanced", "C16")
def choose_balanced(m):
    return C.choose_balanced(_one_per_key(m), 40, _FAMS)


def _one_per_key(m):
    """The pool holds one row per key; copies of a document share a key, so the first one stands."""
    from gradeloom.functions.ordered import first_per_key

    cols = [c for c in m["pool"].columns if c != "pool_key"]
    return first_per_key(m["pool"], ["pool_key"], ["ord"], cols)


@query("choose_quota", "C17", """SELECT family, n FROM (VALUES ('animation', 8::BIGINT), ('equation', 6), ('chart', 12), ('effects', 4)) t(family, n)
WHERE (SELECT count(*) FROM pool) > 0""")
def choose_quota(m):
    quotas = C.parse_quotas("animation=8,equation=6,chart=12,effects=4", _FAMS, 30)
    chosen = C.choose_quota(_one_per_key(m), quotas)
    return chosen.groupBy("family").agg(F.countDistinct("pool_key").alias("n"))


@query("vet_wave", "C18", "WITH " + _CAND + """,
wave AS (SELECT * FROM cand ORDER BY score DESC, pool_key, ord LIMIT 30),
c AS (SELECT ord, coalesce(render_ok, false) AS ok, sum(CASE WHEN render_ok THEN 1 ELSE 0 END) OVER (ORDER BY score DESC, pool_key, ord ROWS UNBOUNDED PRECEDING) AS p FROM wave)
SELECT ord, ok AND p <= 20 AS chosen FROM c""")
def vet_wave(m):
    ranked = C.candidates(_one_per_key(m))
    return C.vet_wave(ranked, 20, 10).select("ord", "chosen")


@query("vet_waves", "C18", "WITH " + _CAND + """,
rk AS (SELECT ord, coalesce(render_ok, false) AS ok, row_number() OVER w AS i, sum(CASE WHEN render_ok THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS p FROM cand WINDOW w AS (ORDER BY score DESC, pool_key)),
wv(wave, lo, hi) AS (SELECT 1::BIGINT, 0::BIGINT, 22::BIGINT UNION ALL SELECT wave + 1, hi, hi + (20 - p)::BIGINT + 2 FROM wv JOIN rk ON rk.i = hi WHERE p < 20)
SELECT ord, wave, ok AND p <= 20 AS chosen FROM rk JOIN wv ON i > lo AND i <= hi""")
def vet_waves(m):
    """Twenty that pass, two spares a wave: later waves make up for what the first ones lose."""
    return C.vet_waves(C.candidates(_one_per_key(m)), 20, 2).select("ord", "wave", "chosen")


@query("batch_manifest", "C19", "WITH " + _CAND + """, top AS (SELECT * FROM cand ORDER BY score DESC, pool_key LIMIT 25)
SELECT p.ord, p.name, coalesce(CASE WHEN p.pool_key IN (SELECT pool_key FROM top) THEN 'batch-new' END, p.used_in) AS used_in FROM pool p""")
def batch_manifest(m):
    chosen = C.choose(_one_per_key(m), 25)
    return C.stamp_used(m["pool"], chosen, "batch-new").select("ord", "name", "used_in")


@query("verify_bytes", "C20", """
WITH files AS (SELECT 'local-' || doc_id || '.pptx' AS name, sha256(CASE WHEN doc_id % 12 = 0 THEN text || '!' ELSE text END) AS actual FROM documents WHERE doc_id % 29 <> 0),
pinned AS (SELECT 'local-' || doc_id || '.pptx' AS name, sha256(text) AS sha256 FROM documents)
SELECT p.name, CASE WHEN f.actual IS NULL THEN 'missing' ELSE 'bytes changed' END AS problem
FROM pinned p LEFT JOIN files f ON p.name = f.name WHERE f.actual IS NULL OR f.actual <> p.sha256""")
def verify_bytes(m):
    docs = m["documents"].withColumn("name", F.concat(F.lit("local-"), F.col("doc_id").cast("string"), F.lit(".pptx")))
    pinned = docs.select("name", F.sha2("text", 256).alias("sha256"))
    actual = docs.where(F.col("doc_id") % 29 != 0).select(
        "name", F.when(F.col("doc_id") % 12 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("content"))
    return C.verify_bytes(pinned, actual).select("name", "problem")


@query("attach_provenance", "C21", """
SELECT p.ord, c.doi, CASE WHEN c.ord % 31 = 0 OR p.ord % 23 = 0 THEN 'no licence or source recorded' END AS problem
FROM pool p LEFT JOIN corpus_index c ON p.filename = c.filename AND p.ord % 23 <> 0""")
def attach_provenance(m):
    lost = F.col("ord") % 23 == 0
    decks = m["pool"].select("ord", F.concat(F.format_string("%03d-", F.col("ord") % 1000),
                                             F.when(lost, "gone.pptx").otherwise(F.col("filename"))).alias("name"))
    index = m["corpus_index"]
    sources = index.select("filename", "doi", "license",
                           F.when(F.col("ord") % 31 == 0, "").otherwise(F.col("url")).alias("url"))
    return C.attach_provenance(decks, sources).select("ord", "doi", "problem")


@query("creators", "C22", """
SELECT c.ord, regexp_extract(doi, 'zenodo\\.([0-9]+)', 1) AS record_id, k.c_name AS creators
FROM corpus_index c LEFT JOIN customer k ON regexp_extract(doi, 'zenodo\\.([0-9]+)', 1) = (100000 + k.c_custkey * 2)::VARCHAR""")
def creators(m):
    cache = m["customer"].select((F.lit(100000) + F.col("c_custkey") * 2).cast("string").alias("record_id"),
                                 F.col("c_name").alias("creators"))
    return C.creators(m["corpus_index"], cache).select("ord", "record_id", "creators")


_PAGES = """
SELECT deck, CASE WHEN deckno % 11 = 0 THEN 25 ELSE 20 END AS expect,
   CASE WHEN deckno % 7 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(content % 9 AS DOUBLE) END AS stddev
FROM (SELECT deck, deckno, slide, count(*) AS content FROM {shapes_gt} GROUP BY deck, deckno, slide) p
"""


@query("render_verdict", "C23", "WITH pg AS (" + _PAGES.replace("{shapes_gt}", "shapes_gt") + """)
SELECT deck, count(*) AS rendered, CASE WHEN count(*) <> max(expect) THEN 'short' WHEN max(stddev) > 4 THEN 'ok' ELSE 'blank' END AS status FROM pg GROUP BY deck""")
def render_verdict(m):
    return C.render_verdict(m.sql(_PAGES)).select("deck", "rendered", "status")


@query("shortlist", "C1 C2 C13 C15", _SELECTED + """,
fresh AS (SELECT s.* FROM selected s WHERE s.kept AND (CASE WHEN s.checksum <> '' THEN s.checksum ELSE s.filename END)
  NOT IN (SELECT pool_key FROM pool WHERE used_in IS NOT NULL))
SELECT f.ord, f.filename, f.family, p.score, 'unused, score ' || CASE WHEN p.score >= 50 THEN 'promising' ELSE 'marginal' END AS why
FROM fresh f JOIN pool p ON f.ord = p.ord WHERE p.status = 'scored' AND p.fonts_missing = '' AND p.score >= 28
ORDER BY p.score DESC, f.ord LIMIT 100""")
def shortlist(m):
    """Top licence-clean, de-duplicated, unused candidates with score and reason."""
    kept = C.select_rows(m["corpus_index"]).where("kept")
    used = m["pool"].where(F.col("used_in").isNotNull())
    fresh = C.todo(kept, used).select("ord", "filename", "family")
    scored = m["pool"].where((F.col("status") == "scored") & (F.col("fonts_missing") == "")
                             & (F.col("score") >= 28)).select("ord", "score")
    why = F.concat(F.lit("unused, score "), F.when(F.col("score") >= 50, "promising").otherwise("marginal"))
    return (fresh.join(scored, "ord").select("ord", "filename", "family", "score", why.alias("why"))
            .orderBy(F.desc("score"), "ord").limit(100))


# ------------------------------------------------------------------ sources and sinks

@query("pool_upsert", "S2", """
SELECT pool_key, score, v * 1000000000 + ord AS version
FROM (SELECT pool_key, ord, score, 1 AS v FROM pool UNION ALL SELECT pool_key, ord, score + 1, 2 FROM pool WHERE ord % 5 = 0) QUALIFY row_number() OVER (PARTITION BY pool_key ORDER BY v DESC, ord DESC) = 1""")
def pool_upsert(m):
    pool = m["pool"].select("pool_key", "ord", F.col("score"))
    old = pool.withColumn("version", F.lit(1000000000) + F.col("ord"))
    new = (pool.where(F.col("ord") % 5 == 0).withColumn("score", F.col("score") + 1)
           .withColumn("version", F.lit(2000000000) + F.col("ord")))
    return S.upsert_pool(old, new).select("pool_key", "score", "version")


#: A log with half-written lines and non-objects among the events.
_LOG = """SELECT ord, CASE WHEN k % 23 = 0 THEN '[1, 2]' WHEN k % 19 = 0 THEN concat('{"event": "', event, '", "deck')
  ELSE concat('{"event": "', event, '", "deck": "', deck, '", "ts": ', CAST(ord AS STRING), '}') END AS line"""


@query("event_log_read", "S3", "WITH log AS (" + _LOG + """ FROM run_events)
SELECT ord, json_extract_string(line, '$.event') AS event, json_extract_string(line, '$.deck') AS deck FROM log
WHERE line NOT LIKE '[%' AND line LIKE '%}'""")
def event_log_read(m):
    lines = m["run_events"].selectExpr("ord", """CASE WHEN k % 23 = 0 THEN '[1, 2]' WHEN k % 19 = 0 THEN concat('{"event": "', event, '", "deck')
      ELSE concat('{"event": "', event, '", "deck": "', deck, '", "ts": ', CAST(ord AS STRING), '}') END AS line""")
    return S.parse_events(lines).where("ok").select("ord", "rec.event", "rec.deck")


@query("timeline_split", "S4", """
SELECT CASE WHEN ord % 100 = 0 THEN 'header' ELSE 'sample' END AS kind, count(*) AS n, min(us // 1000000)::DOUBLE AS first_t, max(us // 1000000)::DOUBLE AS last_t
FROM run_events WHERE k % 19 <> 0 GROUP BY 1""")
def timeline_split(m):
    lines = m["run_events"].selectExpr("""CASE WHEN k % 19 = 0 THEN '{"kind": "sample", ' ELSE concat('{"kind": "', CASE WHEN ord % 100 = 0 THEN 'header' ELSE 'sample' END,
      '", "t": ', CAST(us div 1000000 AS STRING), '}') END AS line""")
    header, samples = S.split_timeline(S.parse_events(lines, S.TIMELINE_SCHEMA).where("ok").select("rec.*"))
    return (header.unionByName(samples).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t")))


@query("session_last_result", "S5", """
SELECT 'log-' || conv_id AS path, max(turn) AS line_no, max_by(length(text), turn)::BIGINT AS chars
FROM conversations WHERE turn % 3 <> 1 GROUP BY conv_id""")
def session_last_result(m):
    lines = m["conversations"].select(
        F.concat(F.lit("log-"), F.col("conv_id").cast("string")).alias("path"), F.col("turn").alias("line_no"),
        F.to_json(F.struct(F.when(F.col("turn") % 3 != 1, "result").otherwise("assistant").alias("type"),
                           F.length("text").alias("chars"))).alias("line"))
    # a conversation may repeat a turn, so only whole-line ties are possible and they are equal rows
    return S.last_result(lines).select("path", "line_no", F.get_json_object("line", "$.chars").cast("long").alias("chars"))


@query("source_discovery", "S6", """
WITH f AS (SELECT CASE page_id % 6 WHEN 0 THEN 'in/~$deck' WHEN 1 THEN 'in/.deck' ELSE 'in/deck' END || (page_id // 2) || CASE page_id % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PPTX' ELSE '.pptx' END AS path,
  lower(url) AS resolved, length(html)::BIGINT AS len FROM pages)
SELECT resolved, min(path) AS path, max(len) AS length FROM f
WHERE lower(path) LIKE '%.pptx' AND path NOT LIKE 'in/~$%' AND path NOT LIKE 'in/.%' GROUP BY resolved""")
def source_discovery(m):
    files = m["pages"].selectExpr(
        "concat(CASE page_id % 6 WHEN 0 THEN 'in/~$deck' WHEN 1 THEN 'in/.deck' ELSE 'in/deck' END, CAST(page_id div 2 AS STRING), CASE page_id % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PPTX' ELSE '.pptx' END) AS path",
        "lower(url) AS resolved", "CAST(length(html) AS BIGINT) AS length")
    return S.list_sources(files)


@query("take_sorted", "S7", "SELECT filename AS path, false AS short FROM corpus_index ORDER BY filename LIMIT 40")
def take_sorted(m):
    return S.take_sorted(m["corpus_index"].select(F.col("filename").alias("path")), 40)


@query("attribution", "S8", """
SELECT ord, '# ' || title || chr(10) || 'licence: ' || trim(license) || chr(10) || 'doi: ' || doi || chr(10) || 'creators: (not recorded)' || chr(10) || 'link: https://doi.org/' || doi AS attribution
FROM corpus_index""")
def attribution(m):
    return S.render_attribution(m["corpus_index"].withColumn("creators", F.lit(None).cast("string"))).select("ord", "attribution")


@query("disk_usage", "S10", "SELECT deck, sum(w)::BIGINT AS bytes, count(*) AS files FROM shapes_gt GROUP BY deck")
def disk_usage(m):
    return S.disk_usage(m["shapes_gt"].select("deck", F.col("w").alias("length")))


# ------------------------------------------------------------------ registration

@query("reject_reason", "G1", """
SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'missing' WHEN 1 THEN 'empty' WHEN 2 THEN 'encrypted' WHEN 3 THEN 'legacy_ppt' WHEN 4 THEN 'not_a_zip'
  WHEN 5 THEN 'corrupt_zip' WHEN 6 THEN 'not_a_deck: word' WHEN 7 THEN 'not_a_deck' END AS reason FROM documents""")
def reject_reason(m):
    docs = m["documents"].selectExpr("doc_id", """CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN CAST('' AS BINARY)
      WHEN 2 THEN concat(unhex('D0CF11E0A1B11AE1'), encode(concat(text, 'EncryptedPackage'), 'UTF-8'))
      WHEN 3 THEN concat(unhex('D0CF11E0A1B11AE1'), encode(text, 'UTF-8')) WHEN 4 THEN encode(text, 'UTF-8')
      ELSE concat(unhex('504B0304'), encode(text, 'UTF-8')) END AS content""",
      """CASE doc_id % 10 WHEN 5 THEN NULL WHEN 6 THEN array('word/document.xml', lang) WHEN 7 THEN array(lang)
      ELSE array('ppt/presentation.xml', lang) END AS listing""")
    return docs.select("doc_id", G.reject_reason(F.col("content"), F.col("listing")).alias("reason"))


@query("register_by_content", "G2", """
WITH f AS (SELECT doc_id AS ord, 'in/' || doc_id AS path, md5(text) AS digest FROM documents),
claims AS (SELECT DISTINCT digest, 'deck' || substr(digest, 1, 4) AS deck FROM f WHERE ord % 10 = 0),
firsts AS (SELECT digest, min(ord) AS f FROM f GROUP BY digest)
SELECT f.ord, CASE WHEN c.deck IS NULL AND f.ord = x.f THEN 'registered' ELSE 'duplicate' END AS disposition,
  CASE WHEN c.deck IS NOT NULL THEN c.deck WHEN f.ord <> x.f THEN 'in/' || x.f END AS holder
FROM f JOIN firsts x USING (digest) LEFT JOIN claims c USING (digest)""")
def register_by_content(m):
    files = m["documents"].select(F.col("doc_id").alias("ord"), F.concat(F.lit("in/"), F.col("doc_id").cast("string")).alias("path"),
                                  F.md5("text").alias("digest"))
    claims = (files.where(F.col("ord") % 10 == 0).select("digest").distinct()
              .withColumn("deck", F.concat(F.lit("deck"), F.substring("digest", 1, 4))))
    return G.register(files, claims).select("ord", "disposition", "holder")


@query("allocate_deck_ids", "G3", """
WITH e AS (SELECT max(doc_id) AS top FROM documents WHERE doc_id % 4 = 0), n AS (SELECT doc_id AS ord, row_number() OVER (ORDER BY doc_id) AS r FROM documents WHERE doc_id % 4 <> 0)
SELECT ord, top + r AS number, 'deck' || lpad((top + r)::VARCHAR, greatest(4, length((top + r)::VARCHAR))::INT, '0') AS deck FROM n, e""")
def allocate_deck_ids(m):
    docs = m["documents"].select(F.col("doc_id").alias("ord"))
    existing = docs.where(F.col("ord") % 4 == 0).select(F.col("ord").alias("number"))
    return G.alloc_ids(docs.where(F.col("ord") % 4 != 0), existing).select("ord", "number", "deck")


@query("latest_rejects", "G4", """
WITH r AS (SELECT event_id AS ord, CASE WHEN user_id % 7 = 0 THEN '' ELSE 'in/u' || user_id END AS path, 'n' || (event_id % 3) AS name, event_type AS reason FROM events WHERE event_type IN ('error', 'view'))
SELECT CASE WHEN path <> '' THEN path ELSE name END AS key, max(ord) AS ord, max_by(reason, ord) AS reason FROM r GROUP BY 1""")
def latest_rejects(m):
    log = m["events"].where(F.col("event_type").isin("error", "view")).selectExpr(
        "event_id AS ord", "CASE WHEN user_id % 7 = 0 THEN '' ELSE concat('in/u', CAST(user_id AS STRING)) END AS path",
        "concat('n', CAST(event_id % 3 AS STRING)) AS name", "event_type AS reason")
    return G.latest_rejects(log).select("key", "ord", "reason")


@query("ingest_summary", "G5", """
WITH d AS (SELECT CASE WHEN doc_id % 10 IN (1, 2, 3) THEN 'rejected' WHEN row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1 THEN 'duplicate' ELSE 'registered' END AS disposition FROM documents)
SELECT disposition, count(*) AS n, NULL::BOOLEAN AS balanced FROM d GROUP BY 1 UNION ALL SELECT 'scanned', count(*), true FROM d""")
def ingest_summary(m):
    files = m["documents"].select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("path"), F.md5("text").alias("digest"))
    none = files.limit(0).select("digest", F.col("path").alias("deck"))
    rows = G.register(files, none).withColumn(
        "disposition", F.when((F.col("ord") % 10).isin(1, 2, 3), "rejected").otherwise(F.col("disposition")))
    return G.ingest_summary(rows)
