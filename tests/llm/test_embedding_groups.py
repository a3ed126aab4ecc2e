"""A cluster of a third of all vectors is split over tasks, and a large group does not hide links that are missed."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gradeloom.llm import embedding_dedup as E


def vectors():
    """300 of 900 vectors around one centre, the others in pairs and alone."""
    rng = np.random.default_rng(11)
    hot = rng.normal(size=12)
    rows = [hot + rng.normal(size=12) * 0.25 for _ in range(300)]
    pairs = [rng.normal(size=12) for _ in range(200)]
    rows += pairs + [p + rng.normal(size=12) * 0.05 for p in pairs] + [rng.normal(size=12) for _ in range(200)]
    return [r.astype(np.float32) for r in rows]


def close_of(rows):
    unit = np.stack(rows).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    return close


def test_a_hot_cluster_in_small_tasks_equals_brute_force(spark):
    rows = vectors()
    close = close_of(rows)
    frame = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(rows)], "vec_id long, embedding array<float>")
    how = {"shard_rows": 300, "most_home": 70, "recall": 0.99}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.near_duplicates(frame, most_asked=90, **how).collect()}
    links = close.sum(axis=1)
    assert all(got[k][0] <= links[k] for k in got)
    assert sum(got[k][0] for k in got) >= 0.98 * close.sum()
    assert np.mean([got[k][0] == links[k] for k in got]) >= 0.97
    assert {k: v for k, v in got.items() if not links[k]} == {k: (0, k) for k in range(len(rows)) if not links[k]}


def test_no_task_holds_more_than_a_part_and_a_block(spark):
    """One shard of 5,000 vectors and one of 40: every vector asks once in every part, every graph node stands in all blocks."""
    placed = spark.range(5040).selectExpr("id AS node", "CAST(NULL AS binary) AS vec", "1L AS n", "CAST(id < 5000 AS int) AS shard", "CAST(id % 4 AS int) AS place")
    rows = E.deal(placed, most_home=200, most_asked=1000, overlap=2).cache()
    sizes = rows.groupBy("shard", "part", "block").agg(F.count_if("asks").alias("asks"), F.count_if("in_graph").alias("stands")).collect()
    hot = [r for r in sizes if r["shard"] == 1]
    assert len(hot) == 7 * 5 and max(r["asks"] for r in hot) < 1200 and max(r["stands"] for r in hot) < 500 and len(sizes) == 36
    per = rows.groupBy("shard", "node").agg(F.count_if("asks").alias("asks"), F.countDistinct("part").alias("parts"), F.count_if("in_graph").alias("stands"),
                                            F.countDistinct(F.when(F.col("in_graph"), F.col("block"))).alias("blocks"), F.count("*").alias("all"), F.first("place").alias("place"))
    wrong = per.where((F.col("asks") != F.when(F.col("shard") == 1, 7).otherwise(1)) | (F.col("asks") != F.col("parts")) | (F.col("stands") != F.col("blocks"))
                      | (F.col("stands") != F.when(F.col("place") >= 2, 0).when(F.col("shard") == 1, 5).otherwise(1)))
    assert wrong.isEmpty()


def test_the_audit_sees_isolated_pairs(spark):
    """All links of a large group found and none of the pairs: the share of links is high, the recall is not."""
    rows = vectors()
    close = close_of(rows)
    nodes = E.valid_vectors(spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(rows)], "vec_id long, embedding array<float>"))
    nodes = nodes.selectExpr("vec_id AS node", "vec", "1L AS n")
    found = pd.DataFrame({"node": range(300), "linked": close[:300].sum(axis=1), "partners": close[:300].sum(axis=1)})
    some = E.audit(nodes, spark.createDataFrame(found), least=0.9, queries=900)
    every = pd.DataFrame({"node": range(len(rows)), "linked": close.sum(axis=1), "partners": close.sum(axis=1)})
    assert close[:300].sum() >= 0.95 * close.sum() and some < 0.5
    assert E.audit(nodes, spark.createDataFrame(every), least=0.9, queries=900) == 1.0
