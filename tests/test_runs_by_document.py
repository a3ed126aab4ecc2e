"""Documents are dealt out whole before they are split into words: no join or count within one shuffles its words."""

import pytest

from gradeloom.operators import compare as X
from gradeloom.plans.registry import bound, load_all

load_all()
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, narrow", [("run_property_credit", 0), ("touched_paragraph_credit", 0), ("damage_text_runs", 1)])
def test_words_are_not_shuffled(spark, name, narrow):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bound(name)(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    # texts are dealt out before they are split; what is asked of a document is one more
    assert plan.count("REPARTITION_BY_NUM") >= 1
    assert sum("Exchange hashpartitioning" in x and "ENSURE_REQUIREMENTS" in x for x in plan.splitlines()) <= narrow


def test_text_recall_counts_words_once(spark):
    plan = bound("text_recall")(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_recall_uses_each_occurrence_once(spark):
    want = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, None)], "k int, t string")
    have = spark.createDataFrame([(1, "a"), (1, "c"), (2, "c"), (2, "c"), (4, "d")], "k int, t string")
    got = {r["k"]: (r["want"], r["hit"]) for r in X.multiset_recall(want, have, ["k"]).collect()}
    assert got == {1: (3, 1), 2: (1, 1), 3: (1, 0)}
