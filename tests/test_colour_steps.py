"""The colour distance is computed in steps: no channel's curve is written out many times."""

from pyspark.sql import functions as F

from gradeloom.functions import colour
from gradeloom.plans.registry import bound, load_all

load_all()


def test_each_power_is_taken_once(spark):
    plan = bound("colour_distance")(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    # six channels, six curves, three squares
    assert plan.lower().count("pow") <= 15


def test_unknown_and_known_distances(spark):
    rows = spark.createDataFrame([("FFFFFF", "000000"), ("102030", "102030"), ("102030", None)], "a string, b string")
    got = colour.with_delta_e(rows, colour.rgb_of(F.col("a")), colour.rgb_of(F.col("b")), "d").collect()
    assert [round(r["d"], 2) for r in got] == [100.0, 0.0, 100.0]
