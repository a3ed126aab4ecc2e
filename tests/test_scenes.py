"""The side-by-side rows of all scenarios in one pass, and what a scoring pass writes."""

import os

from pyspark.sql import functions as F

from gradeloom.operators import matching as M
from gradeloom.operators import scoring as S

SHAPE = ("deck string, slide long, path string, grp string, kind string, z long, cx long, cy long, w long, h long, autofit boolean, fill_type string, fill_color string, line_fill string, "
         "line_color string, line_dash string, effects string, geom string, plain string, name string, blob string, placeholder string, hidden boolean")


def shapes(spark, n=12, shift=0, skip=()):
    rows = [("d", k % 3, f"{k // 2 * 2}/0" if k % 2 else str(k), str(k // 2 * 2) if k % 2 else None, "autoshape" if k % 2 else "group", k, 1000 * (k % 4) + shift, 1000, 400, 400, False,
             None, None, None, None, None, None, None, f"t{k % 5}", f"n{k % 4}", None, None, False) for k in range(n) if k not in skip]
    return spark.createDataFrame(rows, SHAPE)


def scenes(spark):
    gt = shapes(spark)
    frames = (shapes(spark).withColumn("scenario", F.lit("gt")).unionByName(shapes(spark, 14, 300, (2, 5)).withColumn("scenario", F.lit("noop")))
              .unionByName(shapes(spark, 5, 9000).withColumn("slide", F.lit(7).cast("long")).withColumn("scenario", F.lit("elsewhere"))))
    return gt, frames, ["gt", "noop", "elsewhere"]


def expected(spark, gt, frames, names):
    by = ["scenario", "deck", "slide"]
    left, right = M.with_keys(gt), M.with_keys(frames)
    pairs = M.pair(left, right, by, ["deck", "slide"])
    rows = M.side_by_side(gt, frames, pairs, by, ["deck", "slide"], spark.createDataFrame([(n,) for n in names], "scenario string"))
    wide = rows.select(*by, "a_path", "a_cx", "b_path", "b_cx", "key").collect()
    loose = S.unmatched(right, pairs).select(*by, F.lit(None), F.lit(None), "path", "cx", F.lit(None)).collect()
    return sorted((tuple(r) for r in [*wide, *loose]), key=str)


def test_one_pass_gives_pairs_rows_and_loose_shapes(spark, monkeypatch):
    gt, frames, names = scenes(spark)
    want = expected(spark, gt, frames, names)
    for fold in (M.FOLD_SHAPES, 3):                      # pages walked whole, and pages too large for that
        monkeypatch.setattr(M, "FOLD_SHAPES", fold)
        got = M.wide_scenarios(gt.withColumn("mark", F.lit(1)), frames, names, ["cx"], ["mark"])
        rows = got.select("scenario", "deck", "slide", "a_path", "a_cx", "b_path", "b_cx", "key").collect()
        assert sorted((tuple(r) for r in rows), key=str) == want
        assert got.where("(a_path IS NULL) <> (mark IS NULL)").count() == 0


def test_scoring_writes_packed_tables_only(spark):
    gt, frames, _ = scenes(spark)
    comps = spark.createDataFrame([("d", 0, "6", "c1", "delete", "d1", 0.5), ("d", 2, "2", "c2", "move", "d1", 0.5)], "deck string, slide long, gt_path string, id string, op string, deg string, weight double")
    comps = comps.withColumns({c: F.lit(1000).cast("long") for c in ("cx", "cy", "w", "h")})
    folder = S.put_down(comps).inputFiles()[0].replace("file:", "", 1).replace("//", "/").rsplit("/", 2)[0]
    before = set(os.listdir(folder))
    scored = S.Scoring(gt, shapes(spark, 14, 300, (2, 5)), frames, comps, spark.createDataFrame([], "deck string, sha string"), 12192000, 6858000, None, ("delete", "move", "recolor"))
    rows = {(r["scenario"], r["id"]): r["raw"] for r in scored.raw().collect()}
    assert rows["gt", "c1"] == 1.0 and rows["gt", "c2"] == 1.0 and rows["noop", "c2"] == 0.0 and len(rows) == 6
    made = set(os.listdir(folder)) - before
    assert made and all(name.startswith("table-") for name in made)
    # members of a graded container are judged with it, all others are not read
    assert {r[0] for r in scored.wide.where("graded").select("a_path").distinct().collect()} >= {"6", "2"} and scored.wide.where("graded IS NULL").count() > 0
