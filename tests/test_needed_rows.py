"""A scoring pass writes the rows that something reads and judges the return of whole shapes where it is asked for."""

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import matching as M
from gradeloom.operators import scoring as S
from tests.test_scenes import scenes


@pytest.mark.parametrize("fold", [M.FOLD_SHAPES, 3])          # pages walked whole, and pages too large for that
def test_equal_rows_of_unmarked_shapes_are_left_out(spark, monkeypatch, fold):
    monkeypatch.setattr(M, "FOLD_SHAPES", fold)
    gt, frames, names = scenes(spark)
    frames = frames.withColumn("plain", F.when((F.col("scenario") == "gt") & (F.col("path") == "4"), F.lit(None)).otherwise(F.col("plain")))
    marked = gt.withColumn("mark", F.when(F.col("path") == "6", F.lit(True)))
    cols, told = ["cx", "plain"], ["cx", "plain"]
    got, whole = (M.wide_scenarios(marked, frames, names, cols, ["mark"], unless=u) for u in (("mark", told), None))
    same = [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in told]
    want = whole.where(F.col("a_path").isNull() | F.coalesce("mark", F.lit(False)) | F.col("b_path").isNull() | ~(same[0] & same[1]))
    seen = [sorted((str(tuple(r)) for r in df.select(*want.columns).collect())) for df in (got, want)]
    assert seen[0] == seen[1] and 0 < len(seen[0]) < whole.count()


def test_only_returned_shapes_are_judged_whole(spark):
    gt = spark.createDataFrame([("d", 0, "6", None), ("d", 0, "6/0", "6"), ("d", 0, "6/0/1", "6/0"), ("d", 2, "2", None), ("d", 2, "2/0", "2"), ("d", 2, "3", None), ("d", 2, "4", None)],
                               "deck string, slide long, path string, grp string")
    comps = spark.createDataFrame([("d", 0, "6", "delete"), ("d", 0, "6", "move"), ("d", 2, "2", "move"), ("d", 2, "3", None)], "deck string, slide long, gt_path string, op string")
    got = {r["path"]: r["returned"] for r in S.graded_shapes(gt, comps, 2).collect()}
    assert got == {"6": True, "6/0": True, "6/0/1": True, "2": False, "2/0": False, "3": None}
