"""Half restores: exact for any number of units, never nothing or everything."""

from itertools import combinations

from gradeloom.operators import battery as B


def test_half_restore_against_all_subsets(spark):
    decks = {"a": [3, 1, 4, 1, 5], "b": [7], "c": [2, 2, 2, 2], "d": [0, 5], "e": [9, 1, 1, 1], "f": list(range(1, 21))}
    rows = [(d, f"u{k:02d}", n) for d, own in decks.items() for k, n in enumerate(own)]
    got = {r["deck"]: (r["units"], r["mass"]) for r in B.half_restore(spark.createDataFrame(rows, "deck string, unit string, steps long")).collect()}
    for deck, own in decks.items():
        if deck == "f":
            continue
        total = sum(own)
        sets = [s for k in range(1, len(own)) for s in combinations(range(len(own)), k) if 0 < sum(own[i] for i in s) < total]
        if not sets:
            assert got[deck] == (None, None)
            continue
        best = min(sets, key=lambda s: (abs(2 * sum(own[i] for i in s) - total), len(s), sum(1 << i for i in s)))
        assert got[deck] == (",".join(f"u{i:02d}" for i in best), sum(own[i] for i in best) / total)
    assert got["f"][1] == 0.5
