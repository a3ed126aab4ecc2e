"""Block-wise ordered helpers equal the plain window."""

import random
import statistics

from pyspark.sql import Window
from pyspark.sql import functions as F

from gradeloom.functions import ordered as O


def rows(spark, n=400, hot=0.6):
    rng = random.Random(5)
    data = [("hot" if rng.random() < hot else f"k{rng.randrange(5)}", i // 37, i, rng.choice([None, 1.5, 2.0, 7.25]), rng.randrange(90)) for i in range(n)]
    return spark.createDataFrame(data, "k string, block long, i long, v double, x long"), data


def test_previous_next_and_running(spark):
    df, _ = rows(spark)
    w = Window.partitionBy("k").orderBy("i")
    plain = df.select("i", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("p"),
                      F.first("v", True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("n"),
                      F.sum("x").over(w).alias("s"))
    want = {r.i: (r.p, r.n, r.s) for r in plain.collect()}
    got = O.with_previous(df, ["k"], "block", ["i"], F.col("v"), "p")
    got = O.with_next(got, ["k"], "block", ["i"], F.col("v"), "n")
    got = O.running_sum(got, ["k"], "block", ["i"], F.col("x"), "s")
    assert {r.i: (r.p, r.n, r.s) for r in got.collect()} == want


def test_ranked_rows_and_median(spark):
    df, data = rows(spark)
    got = O.ranked_rows(df, [F.desc("i")], "place").select("i", "place").collect()
    assert {r.i: r.place for r in got} == {i: 399 - i for i in range(400)}
    by = {}
    for k, _, _, _, x in data:
        by.setdefault(k, []).append(x)
    med = {r.k: r.m for r in O.exact_median(df, ["k"], "x", 10.0, "m").collect()}
    assert med == {k: statistics.median(v) for k, v in by.items()}


def test_first_and_last_per_key(spark):
    df, data = rows(spark)
    first = {r.k: r.x for r in O.first_per_key(df, ["k"], ["i"], ["x"]).collect()}
    last = {r.k: r.x for r in O.last_per_key(df, ["k"], ["i"], ["x"]).collect()}
    for k in first:
        mine = [d for d in data if d[0] == k]
        assert first[k] == mine[0][4] and last[k] == mine[-1][4]
