"""Operations on child tables, whole composites and nested groups in one scoring pass."""

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import compare as X
from gradeloom.operators import scoring as S
from gradeloom.operators.graded import CHILD_OPS, Facts, content_scores
from gradeloom.operators.structure import identity_keys
from tests.test_scoring import SHAPE, beside

DETAIL = "deck string, id string, what string, i long, j long, t string, u string"


def rows(spark, kinds):
    """One shape per (path, grp, kind)."""
    data = [("d", 0, path, grp, kind, k, 914400 * (k + 1), 914400, 914400, 914400, False, 0.0, None, None, None, None, None, 100, None, "",
             "Arial", 1000, False, None, None, None, None) for k, (path, grp, kind) in enumerate(kinds)]
    return spark.createDataFrame(data, SHAPE).withColumns({"geom": F.lit("rect"), "placeholder": F.lit(None).cast("string"), "name": F.concat(F.lit("n"), "path")})


def named(want, **scenarios):
    out = None
    for name, df in scenarios.items():
        df = df.withColumn("scenario", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return want, out


def test_members_of_nested_groups_are_rolled_up_three_levels(spark):
    gt = rows(spark, [("0", None, "group"), ("0/0", "0", "group"), ("0/0/0", "0/0", "autoshape"), ("0/0/1", "0/0", "autoshape"), ("0/1", "0", "autoshape"), ("5", None, "autoshape")])
    half = gt.where("path <> '0/0/1'")
    wide = beside(gt, gt, "gt").unionByName(beside(gt, half, "half"))
    got = {(r["scenario"], r["path"]): r["raw"] for r in X.restored(wide, {}, depth=3, keys=["scenario", "deck", "slide"]).collect()}
    assert got["gt", "0"] == got["gt", "0/0"] == got["gt", "5"] == got["half", "5"] == 1.0
    inner = (3 * 0.5 + 1) / 4                                   # members 3, outline 1
    assert got["half", "0/0"] == pytest.approx(inner) and got["half", "0/0/1"] == 0.0
    assert got["half", "0"] == pytest.approx((3 * (inner + 1) / 2 + 1) / 4)
    shallow = {(r["scenario"], r["path"]): r["raw"] for r in X.restored(wide, {}, depth=1, keys=["scenario", "deck", "slide"]).collect()}
    assert shallow["half", "0"] > got["half", "0"]


def cells_of(spark, text):
    return spark.createDataFrame([("d", 0, "0", r, c, text(r, c)) for r in range(3) for c in range(2)], "deck string, slide long, path string, r long, c long, text string")


def test_a_table_put_back_is_judged_by_its_cells(spark):
    gt = rows(spark, [("0", None, "table"), ("1", None, "autoshape")])
    moved = gt.where("path = '0'").withColumn("path", F.lit("9")).unionByName(gt.where("path = '1'"))
    wide = beside(gt, gt, "gt").unionByName(beside(gt, gt, "empty"))
    # the counterpart has another path: its cells are found through the pairing
    back = beside(gt, moved.withColumn("path", F.lit("0")).limit(1), "moved").withColumn("b_path", F.when(F.col("a_path") == "0", "9"))
    wide = wide.unionByName(back)
    full = cells_of(spark, lambda r, c: f"{r}{c}")
    pair = named(full, gt=full, empty=full.withColumn("text", F.when(F.col("r") == 0, F.col("text")).otherwise("")), moved=full.withColumn("path", F.lit("9")))
    facts = Facts(spark.createDataFrame([], DETAIL), cells=pair)
    comps = spark.createDataFrame([("d", 0, "0", "c", "delete")], "deck string, slide long, gt_path string, id string, op string")
    got = {r["scenario"]: r["raw"] for r in S.component_raw(comps, wide, content_scores(facts, wide), ["delete"], facts, 3).collect()}
    assert got == {"gt": 1.0, "empty": pytest.approx(1 / 3), "moved": 1.0}


def test_every_child_operation_and_an_unknown_one(spark):
    gt = rows(spark, [("0", None, "table"), ("1", None, "chart"), ("2", None, "smartart"), ("3", None, "textbox")])
    wide = beside(gt, gt, "gt").unionByName(beside(gt, gt, "noop"))
    full = cells_of(spark, lambda r, c: f"{r}{c}")

    def made(data, columns):
        return spark.createDataFrame([("d", 0, *row) for row in data], "deck string, slide long, " + columns)

    series = made([("1", s, f"S{s}", i, float(i + s), f"k{i}") for s in range(2) for i in range(3)], "path string, sno long, sname string, i long, val double, category string")
    nodes = made([("2", t) for t in "abc"], "path string, t string")
    title = made([("1", "title", "T")], "path string, element string, value string")
    runs = made([("3", p, 0, f"text {p}", "Arial", 12) for p in range(2)], "path string, para long, run long, t string, font string, sz long")
    effects = made([(s, "entr", "fade", "x", "click", s) for s in range(3)], "step long, cls string, preset string, subtype string, trigger_kind string, dur_ms long")
    pages = made([("a note", "fade")], "notes string, transition string")
    marks = spark.createDataFrame([("d", p, str(k), f"{p}-{k}") for p in range(4) for k in range(3)], "deck string, slide long, path string, plain string")
    layouts = gt.withColumn("layout", F.lit("Title")).withColumn("keys", identity_keys())
    swapped = marks.withColumn("slide", F.when(F.col("slide") == 1, 2).when(F.col("slide") == 2, 1).otherwise(F.col("slide")).cast("long"))
    ops = [*CHILD_OPS, "teleport"]
    details = [("clear_table_cells", "cell", 1, 0, None, None), ("table_drop_rows", "row", 1, None, None, None), ("table_drop_cols", "col", 1, None, None, None),
               ("smartart_drop_nodes", "node", None, None, "b", None), ("chart_edit", "series", None, None, "S1", None), ("chart_edit", "element", None, None, "title", None),
               ("text_runs", "paragraph", 0, None, "deleted", None), ("text_runs", "paragraph", 1, None, "restyled", None), ("anim_drop_steps", "step", 1, None, None, None),
               ("reorder_slides", "swap", 1, 2, None, None), ("delete_slides", "cut", 3, None, None, None), ("layout_edit", "layout", None, None, "Title", "1")]
    # one state lacks all of it at once
    facts = Facts(
        spark.createDataFrame([("d", *row) for row in details], DETAIL),
        cells=named(full, gt=full, noop=full.where("r <> 1 and c <> 1")), series=named(series, gt=series, noop=series.where("sno = 0")),
        elements=named(title, gt=title, noop=title.limit(0)), nodes=named(nodes, gt=nodes, noop=nodes.where("t <> 'b'")),
        runs=named(runs, gt=runs, noop=runs.where("para = 1").withColumns({"font": F.lit("X"), "sz": F.lit(1).cast("long")})),
        effects=named(effects, gt=effects, noop=effects.where("step = 5")), pages=named(pages, gt=pages, noop=pages.withColumns({"notes": F.lit(""), "transition": F.lit(None).cast("string")})),
        shapes=named(marks, gt=marks, noop=swapped.where("slide < 3")), layouts=named(layouts, gt=layouts, noop=layouts.where("path = '2'")))
    place = {"clear_table_cells": "0", "table_drop_rows": "0", "table_drop_cols": "0", "smartart_drop_nodes": "2", "chart_edit": "1", "text_runs": "3"}
    comps = spark.createDataFrame([("d", 0, place.get(op), op, op) for op in ops], "deck string, slide long, gt_path string, id string, op string")
    scored = S.normalise_by_floor(S.component_raw(comps, wide, facts=facts), "noop").collect()
    got = {(r["scenario"], r["op"]): (r["raw"], r["score"]) for r in scored}
    assert len(got) == 2 * len(ops)
    for op in CHILD_OPS:
        assert got["gt", op] == (1.0, 1.0) and got["noop", op][1] == 0.0 and got["noop", op][0] is not None, op
    assert got["gt", "teleport"] == (None, 0.0)
    # without its facts an operation is undecided, not lost
    bare = S.component_raw(comps, wide, facts=Facts(facts.details)).collect()
    assert len(bare) == 2 * len(ops) and all(r["raw"] is None for r in bare)
