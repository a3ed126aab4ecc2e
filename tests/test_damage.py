"""Repeated steps, nested containers and drawing order within a parent; whole fixed tables."""

from pyspark.sql import functions as F

from gradeloom.operators import claims as C
from gradeloom.operators import damage as D
from gradeloom.operators.structure import script_of

SHAPE = "deck string, slide long, path string, grp string, kind string, z long, cx long, cy long, w long, h long, fill_type string, fill_color string"


def shapes(spark, *paths):
    rows = [("d", 0, p, p.rpartition("/")[0] or None, "group", k, 100, 100, 50, 50, None, None) for k, p in enumerate(paths)]
    return spark.createDataFrame(rows, SHAPE)


def test_two_steps_on_one_shape_keep_one_row(spark):
    steps = spark.createDataFrame([("d", 0, "0", "d2", 2, 1.0, 0.0), ("d", 0, "0", "d1", 1, 0.5, 0.0)],
                                  "deck string, slide long, path string, deg string, step_no int, dx_in double, dy_in double")
    out, log = D.edit(shapes(spark, "0", "1"), steps, "move")
    assert {r["path"]: r["cx"] for r in out.collect()} == {"0": 100 + 457200 + 914400, "1": 100} and out.count() == 2
    assert [(r["deg"], r["was"], r["now"]) for r in log.orderBy(F.col("was").cast("long")).collect()] == [("d1", "100", "457300"), ("d2", "457300", "1371700")]


def test_recipe_mixes_operations_in_order(spark):
    steps = spark.createDataFrame([("d", 0, "0", "d1", 1, "recolor", None, None, "srgb:00"), ("d", 0, "0", "d1", 2, "move", 1.0, 0.0, None), ("d", 0, "0", "d2", 3, "recolor", None, None, "srgb:11")],
                                  "deck string, slide long, path string, deg string, step_no int, op string, dx_in double, dy_in double, color string")
    out, log = D.apply_recipe(shapes(spark, "0"), steps)
    row = out.first()
    assert (row["cx"], row["fill_type"], row["fill_color"]) == (914500, "solid", "srgb:11") and log.count() == 4


def test_delete_takes_all_depths(spark):
    steps = spark.createDataFrame([("d", 0, "0", "d1")], "deck string, slide long, path string, deg string")
    left, log = D.delete(shapes(spark, "0", "0/0", "0/0/0", "00", "1"), steps)
    assert sorted(r["path"] for r in left.collect()) == ["00", "1"] and log.count() == 3


def test_zorder_stays_within_the_parent(spark):
    steps = spark.createDataFrame([("d", 0, "1/1", "d1", "back"), ("d", 0, "2", "d2", "back"), ("d", 0, "0", "d3", "back")], "deck string, slide long, path string, deg string, to string")
    out, log = D.zorder(shapes(spark, "0", "1", "1/0", "1/1", "2"), steps)
    assert {r["path"]: r["z"] for r in out.collect()} == {"0": 0, "2": 1, "1": 4, "1/1": 2, "1/0": 3}
    assert {r["path"] for r in log.collect()} == {"1/1", "2"}


def test_exemption_cues_of_several_words(spark):
    docs = spark.createDataFrame([("a", "On slide 3 you do not need to fix the text colours. Please leave the entrance effects alone."), ("b", "The speaker notes on slide 2 can stay as they are.")], "deck string, text string")
    split = C.sentences(docs, ["deck"])
    got = {(r["deck"], r["bucket"]) for r in C.excused_work(split, C.tokenise(split)).collect()}
    assert got == {("a", "typography"), ("a", "animation"), ("b", "notes")}


def test_component_named_by_two_cues_counts_once(spark):
    excuses = spark.createDataFrame([("a", 0, "animation", "x", True, None), ("a", 1, "animation", "y", True, None)], "deck string, sent long, bucket string, cue string, whole_deck boolean, pages array<long>")
    parts = spark.createDataFrame([("a", 0, "anim_steps", "k", "c1", 0.25)], "deck string, slide long, op string, kind string, id string, weight double")
    row = C.excused_components(excuses, parts).first()
    assert (row["components"], row["weight"]) == (1, 0.25)


def test_scripts_of_the_whole_table(spark):
    want = {0x0995: "Bengali", 0x0F40: "Tibetan", 0xFF71: "Han", 0xFF0C: "Han", 0x3105: "Bopomofo", 0x10D0: "Georgian", 0x3001: "Han", 0x41: "Latin", 0x870: "Unknown"}
    frame = spark.createDataFrame([(k,) for k in want], "cp long").select("cp", script_of(F.col("cp")).alias("s"))
    assert {r["cp"]: r["s"] for r in frame.collect()} == want
