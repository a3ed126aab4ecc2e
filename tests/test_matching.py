"""Pairing against a brute-force walk, on folds and on rounds."""

import random

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import matching as M

TYPE = "deck string, slide long, path string, z long, cx long, cy long, w long, h long, keys array<string>"


def shapes(seed, n):
    rng = random.Random(seed)
    out = []
    for page in range(3):
        for i in range(n):
            keys = [f"txt:{rng.randrange(6)}"] if rng.random() < 0.7 else []
            keys += [f"name:{rng.randrange(4)}", f"kind:{rng.randrange(2)}"]
            out.append(("d", page, str(i), i, rng.randrange(40) * 100000, rng.randrange(40) * 100000, 300000, 300000, keys))
    return out


def brute(gt, other):
    taken, used, out = set(), set(), {}
    props = []
    for a in gt:
        for b in other:
            if a[1] != b[1]:
                continue
            for rank, key in enumerate(a[8]):
                if key not in b[8]:
                    continue
                weak = key.startswith(("name:", "geo:", "kind:"))
                apart = any(abs(a[c] - b[c]) * 2 > a[s] + b[s] + 2 * 9144 for c, s in ((4, 6), (5, 7)))
                if not (weak and apart):
                    props.append(((rank, (a[4] - b[4]) ** 2 + (a[5] - b[5]) ** 2, a[2], b[3], b[2]), a, b))
                break
    for _, a, b in sorted(props, key=lambda p: p[0]):
        if (a[1], a[2]) in taken or (b[1], b[2]) in used:
            continue
        taken.add((a[1], a[2]))
        used.add((b[1], b[2]))
        out[(a[1], a[2])] = b[2]
    return out


@pytest.mark.parametrize("limit", [2000, 5])
def test_pairing_is_the_ordered_walk(spark, monkeypatch, limit):
    monkeypatch.setattr(M, "FOLD_SHAPES", limit)
    gt, other = shapes(1, 14), shapes(2, 12)
    got = M.pair(spark.createDataFrame(gt, TYPE), spark.createDataFrame(other, TYPE)).collect()
    assert {(r.slide, r.gt_path): r.other_path for r in got} == brute(gt, other)


def test_a_snapshot_pairs_with_itself(spark):
    gt = [g[:4] + (i * 700000, g[5]) + g[6:] for i, g in enumerate(shapes(3, 10))]
    df = spark.createDataFrame(gt, TYPE)
    assert M.pair(df, df).where(F.col("gt_path") != F.col("other_path")).count() == 0


def piled(seed, n):
    """Few places and sizes, piles of equal shapes, some with a name of their own, some without text, ids in no order."""
    rng = random.Random(seed)
    out = []
    for i, path in enumerate(rng.sample(range(100, 999), n)):
        keys = [f"txt:{rng.randrange(2)}"] if rng.random() < 0.8 else []
        keys += [f"name:{path if rng.random() < 0.5 else 'n'}"] + [f"kind:{rng.randrange(2)}"]
        out.append(("d", 0, str(path), rng.randrange(4), rng.randrange(3) * 250000, rng.randrange(2) * 250000 - 100000, *rng.choice([(300000, 300000), (0, 0), (900000, 20)]), keys))
    return out


def test_piles_of_equal_shapes_pair_as_the_ordered_walk(spark, monkeypatch):
    monkeypatch.setattr(M, "FOLD_SHAPES", 5)
    gt, other = piled(4, 40), piled(5, 36)
    got = M.pair(spark.createDataFrame(gt, TYPE), spark.createDataFrame(other, TYPE)).collect()
    assert {(r.slide, r.gt_path): r.other_path for r in got} == brute(gt, other) and len(got) == len(brute(gt, other))


def test_nearest_centres_are_the_nearest(spark):
    rng = random.Random(6)
    cloud = lambda n: [("k", *rng.choice([(rng.randrange(50), rng.randrange(50)), (rng.randrange(10**7), -rng.randrange(10**7)), (10**12 + rng.randrange(9), 5)])) for _ in range(n)]
    here, there = cloud(60), cloud(25)
    got = {tuple(r) for r in M.nearest_centres(spark.createDataFrame(here, "key string, cx long, cy long"), spark.createDataFrame(there, "key string, cx long, cy long"), ["key"]).collect()}
    apart = lambda p, q: (p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2
    assert got == {(*p, *q[1:]) for p in here for q in there if apart(p, q) == min(apart(p, x) for x in there)}


def test_a_page_of_20000_equal_shapes(spark):
    """15,000 on a lattice, all a little moved, and a pile of 5,000: each with its own, the pile in order."""
    n, pile = 20_000, 5_000
    base = spark.range(n).select(
        F.lit("d").alias("deck"), F.lit(0).cast("long").alias("slide"), F.format_string("%05d", "id").alias("path"), F.col("id").alias("z"),
        F.when(F.col("id") < pile, -900_000).otherwise(F.col("id") % 150 * 80_000).cast("long").alias("cx"),
        F.when(F.col("id") < pile, -900_000).otherwise(F.floor(F.col("id") / 150) * 80_000).cast("long").alias("cy"),
        F.lit(70_000).cast("long").alias("w"), F.lit(70_000).cast("long").alias("h"), F.array(F.lit("txt:same"), F.lit("kind:shape")).alias("keys"))
    moved = base.withColumn("cx", F.col("cx") + F.when(F.col("z") < pile, 0).otherwise(1000))
    got = M.pair(base, moved)
    assert got.count() == n and got.where(F.col("gt_path") != F.col("other_path")).isEmpty()
