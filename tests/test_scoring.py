"""Every operation scores one on the answer, nothing on the damaged file, and less than one with a wrong value."""

from pyspark.sql import functions as F

from gradeloom.operators import damage as D
from gradeloom.operators import scoring as S

SHAPE = ("deck string, slide long, path string, grp string, kind string, z long, cx long, cy long, w long, h long, autofit boolean, rot double, fill_type string, "
         "fill_color string, line_fill string, line_color string, line_dash string, line_w long, effects string, plain string, font string, sz long, bold boolean, "
         "blob string, crop string, start_id long, end_id long")
OPS = {"move": ({"dx_in": 0.5, "dy_in": 0.0}, {"cx": 5}), "resize": ({"factor": 2.0, "keep_centre": True}, {"w": 7}), "rotate": ({"angle": "45"}, {"rot": 9.0}),
       "recolor": ({"color": "srgb:1"}, {"fill_color": "srgb:2"}), "outline": ({"color": "srgb:1", "width": 9}, {"line_color": "srgb:2"}),
       "strip_effects": ({}, {"effects": "other"}), "clear_text": ({"keep_first": False}, {"plain": "one"}), "set_text": ({"text": "x"}, {"plain": "two y"}),
       "set_font": ({"new_font": "F", "new_sz": 5, "new_bold": True}, {"font": "G"})}


def shapes(spark):
    rows = [("d", 0, str(k), None, "autoshape", k, 914400, 914400, 914400, 914400, False, 0.0, "gradient", "srgb:0", "solid", "srgb:0", None, 100, "glow", "one two two",
             "Arial", 1000, False, None, None, None, None) for k in range(len(OPS))]
    return spark.createDataFrame(rows, SHAPE)


def beside(gt, frame, scenario):
    cols = [c for c in gt.columns if c not in ("deck", "slide")]
    left = gt.select("deck", "slide", *[F.col(c).alias(f"a_{c}") for c in cols])
    right = frame.select("deck", "slide", F.col("path").alias("a_path"), *[F.col(c).alias(f"b_{c}") for c in cols])
    return left.join(right, ["deck", "slide", "a_path"], "left").withColumns({"scenario": F.lit(scenario), "theme": F.lit(None).cast("map<string,string>"), "strong": F.lit(True)})


def test_each_operation_has_a_comparator(spark):
    gt = shapes(spark)
    params = {c: v for own, _ in OPS.values() for c, v in own.items()}
    steps = None
    for k, (op, (own, _)) in enumerate(OPS.items()):
        row = spark.range(1).select(F.lit("d").alias("deck"), F.lit(0).cast("long").alias("slide"), F.lit(str(k)).alias("path"), F.lit("d1").alias("deg"), F.lit(op).alias("op"),
                                    *[(F.lit(own[c]) if c in own else F.lit(None).cast({bool: "boolean", int: "int", float: "double", str: "string"}[type(v)])).alias(c) for c, v in params.items()])
        steps = row if steps is None else steps.unionByName(row)
    broken = D.apply_recipe(gt, steps)[0]
    wrong = gt
    for k, (_, change) in enumerate(OPS.values()):
        wrong = wrong.withColumns({c: F.when(F.col("path") == str(k), F.lit(v)).otherwise(F.col(c)).cast(dict(gt.dtypes)[c]) for c, v in change.items()})
    wide = beside(gt, gt, "gt").unionByName(beside(gt, broken, "noop")).unionByName(beside(gt, wrong, "wrong"))
    comps = steps.select("deck", "slide", F.col("path").alias("gt_path"), F.col("path").alias("id"), "op")
    scored = S.normalise_by_floor(S.component_raw(comps, wide, ops=list(OPS)), "noop").collect()
    by = {(r["scenario"], r["op"]): r["score"] for r in scored}
    assert len(by) == 3 * len(OPS)
    assert all(by["gt", op] == 1.0 and by["noop", op] == 0.0 and by["wrong", op] < 1.0 for op in OPS)


def test_order_and_groups_are_scored_per_scenario(spark):
    gt = shapes(spark).where("path < '4'")
    gt = gt.withColumn("grp", F.when(F.col("path").isin("2", "3"), "1")).withColumn("kind", F.when(F.col("path") == "1", "group").otherwise(F.col("kind")))
    broken = gt.withColumn("z", F.when(F.col("path") == "0", 9).otherwise(F.col("z"))).withColumn("grp", F.lit(None).cast("string")).where("path <> '1'")
    wide = beside(gt, gt, "gt").unionByName(beside(gt, broken, "noop"))
    comps = spark.createDataFrame([("d", 0, "0", "a", "zorder", None), ("d", 0, "1", "b", "ungroup", None)], "deck string, slide long, gt_path string, id string, op string, to string")
    got = {(r["scenario"], r["id"]): r["raw"] for r in S.component_raw(comps, wide, ops=["zorder", "ungroup"]).collect()}
    assert got["gt", "a"] == 1.0 and got["gt", "b"] == 1.0 and got["noop", "b"] == 0.0
