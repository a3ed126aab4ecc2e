"""Pairing of whole pages in one pass: against the plain walk in both orders, with what stays alone, and its shuffles."""

import random

import pytest

from gradeloom.operators import matching as M

TYPE = "deck string, slide long, path string, z long, cx long, cy long, w long, h long, keys array<string>, tag string"


def shapes(seed, n, mark):
    rng = random.Random(seed)
    out = []
    for deck in ("deck000000001", "deck000000002", "deck000000003"):
        for i, path in enumerate(rng.sample(range(90, 300), rng.choice((0, 1, n)))):
            keys = [f"txt:{rng.randrange(5)}"] if rng.random() < 0.6 else []
            keys += [f"name:{rng.randrange(3)}", f"kind:{rng.randrange(2)}"]
            box = [rng.randrange(9) * 200000, rng.randrange(9) * 200000, 300000, 300000]
            if rng.random() < 0.1:
                box[rng.randrange(4)] = None
            out.append((deck, 4, str(path), rng.choice((None, *range(5))), *box, keys, f"{mark}{i}"))
    return out


def brute(gt, other, drift):
    props, a_taken, b_taken, out = [], set(), set(), {}
    for a in gt:
        for b in other:
            shared = [r for r, k in enumerate(a[8]) if k in b[8]]
            if a[0] != b[0] or not shared:
                continue
            weak, whole = a[8][shared[0]].startswith(("name:", "kind:")), None not in (*a[4:8], *b[4:8])
            apart = [abs(a[c] - b[c]) * 2 > a[s] + b[s] + 18288 for c, s in ((4, 6), (5, 7)) if None not in (a[c], b[c], a[s], b[s])]
            # three-valued: a known gap tells apart even where the other axis is unknown
            if not drift and weak and any(apart):
                continue
            far = (a[4] - b[4]) ** 2 + (a[5] - b[5]) ** 2 if None not in (*a[4:6], *b[4:6]) else 0
            z = lambda s: -1 if s[3] is None else s[3]
            rest = (shared[0], far)
            props.append(((z(a), a[2], *rest, z(b), b[2]) if drift else (*rest, a[2], z(b), b[2]), a, b, a[8][shared[0]]))
    for _, a, b, key in sorted(props, key=lambda p: p[0]):
        if (a[0], a[2]) not in a_taken and (b[0], b[2]) not in b_taken:
            a_taken.add((a[0], a[2]))
            b_taken.add((b[0], b[2]))
            out[a[0], a[2]] = (b, key)
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("drift", [False, True])
def test_wide_pairs_are_the_plain_walk(spark, seed, drift):
    gt, other = shapes(seed, 25, "a"), shapes(seed + 50, 22, "b")
    order = M.DRIFT_ORDER if drift else M.PAIR_ORDER
    got = M.wide_pairs(spark.createDataFrame(gt, TYPE), spark.createDataFrame(other, TYPE), ["tag"], order=order, weak_must_meet=not drift, alone=True).collect()
    want = brute(gt, other, drift)
    rows = {(g[0], g[2], g[9], *((want[g[0], g[2]][0][2], want[g[0], g[2]][0][9], want[g[0], g[2]][1]) if (g[0], g[2]) in want else (None,) * 3)) for g in gt}
    used = {(b[0], b[2]) for b, _ in want.values()}
    rows |= {(b[0], None, None, b[2], b[9], None) for b in other if (b[0], b[2]) not in used}
    assert {(r.deck, r.a_path, r.a_tag, r.b_path, r.b_tag, r.key) for r in got} == rows and len(got) == len(rows)


def test_shapes_are_shuffled_once(spark):
    gt, other = (spark.createDataFrame(shapes(s, 9, "x"), TYPE) for s in (1, 2))
    plan = M.wide_pairs(gt, other, ["tag"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


@pytest.mark.parametrize("order", [M.PAIR_ORDER, M.DRIFT_ORDER])
def test_scenarios_pair_as_the_fold_over_all_proposals(spark, order):
    """The answer has no scenario; each scenario of the other side is paired by itself."""
    gt = spark.createDataFrame(shapes(7, 20, "a"), TYPE)
    other = None
    for n in range(3):
        rows = spark.createDataFrame(shapes(20 + n, 18, "b"), TYPE).selectExpr(f"'s{n}' AS scenario", "*")
        other = rows if other is None else other.unionByName(rows)
    by, gt_by, weak = ["scenario", "deck", "slide"], ["deck", "slide"], order == M.PAIR_ORDER
    got = {tuple(r) for r in M.pair(gt, other, by, gt_by, order, weak).select(*by, "gt_path", "other_path", "key", "strong").collect()}
    want = {tuple(r) for r in M._fold(M.proposals(gt, other, by, gt_by, weak), by, order).select(*by, "gt_path", "other_path", "key", "strong").collect()}
    assert got == want and got
