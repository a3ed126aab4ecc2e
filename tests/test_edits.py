"""Vetting in waves, and edits of notes, layouts, diagrams and charts, on small tables against plain answers."""

import random

from gradeloom.operators import corpus as C
from gradeloom.operators import damage as D


def plain_waves(oks, need, spares):
    """Wave of each vetted row and whether it is chosen, one wave after the other."""
    out, at, wave = [], 0, 0
    while sum(oks[:at]) < need and at < len(oks):
        wave += 1
        take = need - sum(oks[:at]) + spares
        for ok in oks[at:at + take]:
            out.append((wave, ok and sum(o for _, o in out) < need))
        at += take
    return out


def test_waves_against_plain_python(spark):
    rng = random.Random(5)
    for share, need, spares in ((0.9, 5, 2), (0.2, 6, 0), (0.3, 30, 3), (0.0, 2, 1)):
        oks = [rng.random() < share for _ in range(40)]
        rows = [(f"k{i:02d}", float(40 - i // 2), ok if ok or i % 3 else None) for i, ok in enumerate(oks)]
        got = C.vet_waves(spark.createDataFrame(rows, "pool_key string, score double, render_ok boolean").repartition(3), need, spares)
        got = [(r["wave"], r["chosen"]) for r in got.orderBy("position").collect()]
        assert got == plain_waves(oks, need, spares)


def test_waves_of_nothing(spark):
    none = spark.createDataFrame([], "pool_key string, score double, render_ok boolean")
    assert C.vet_waves(none, 3, 1).count() == 0


def test_notes(spark):
    pages = spark.createDataFrame([("d", 0, " keep me "), ("d", 1, "  "), ("d", 2, None), ("d", 3, "x" * 500), ("e", 0, "other")], "deck string, slide long, notes string")
    steps = spark.createDataFrame([("d", k, "d1") for k in (0, 1, 2, 3, 3, 9)], "deck string, slide long, deg string")
    left, log = D.clear_notes(pages, steps)
    assert sorted((r["slide"], r["was"]) for r in log.collect()) == [(0, "keep me"), (3, "x" * 400)]
    assert {(r["deck"], r["slide"]): r["notes"] for r in left.collect()} == {("d", 0): "", ("d", 1): "  ", ("d", 2): None, ("d", 3): "", ("e", 0): "other"}


def test_layouts(spark):
    layouts = spark.createDataFrame([("d", "T", "1", None, "group", "g"), ("d", "T", "1/0", "1", "picture", "p"), ("d", "T", "10", None, "textbox", "t"), ("d", "B", "1", None, "textbox", "b")],
                                    "deck string, layout string, path string, grp string, kind string, name string")
    pages = spark.createDataFrame([("d", 0, "T"), ("d", 1, "T"), ("d", 2, "B"), ("d", 3, None)], "deck string, slide long, layout string")
    steps = spark.createDataFrame([("d", "T", "1", "d1"), ("d", "T", "99", "d1"), ("d", "T", "1/0", "d2")], "deck string, layout string, path string, deg string")
    left, log = D.layout_edit(layouts, pages, steps)
    assert [tuple(r) for r in log.collect()] == [("d", "T", "1", "d1", "group", "g", 2)]
    assert sorted((r["layout"], r["path"]) for r in left.collect()) == [("B", "1"), ("T", "10")]


def test_diagrams_and_charts(spark):
    key = "deck string, slide long, path string"
    nodes = spark.createDataFrame([("d", 0, "1", i, i, t) for i, t in enumerate("abca")], f"{key}, node long, ord long, t string")
    links = spark.createDataFrame([("d", 0, "1", a, b) for a, b in ((0, 1), (1, 2), (2, 3), (2, 2))], f"{key}, a long, b long")
    left, joined, log = D.drop_nodes(nodes, links, spark.createDataFrame([("d", 0, "1", "c", "d1"), ("d", 0, "1", "zz", "d1")], f"{key}, t string, deg string"))
    assert sorted((r["ord"], r["node"]) for r in left.collect()) == [(0, 0), (1, 1), (2, 3)]
    assert [(r["a"], r["b"]) for r in joined.collect()] == [(0, 1)] and [(r["node"], r["links"]) for r in log.collect()] == [(2, 3)]
    elements = spark.createDataFrame([("d", 0, "1", "title", "T"), ("d", 0, "1", "axis", None)], f"{key}, element string, value string")
    kept, log = D.strip_elements(elements, spark.createDataFrame([("d", 0, "1", "title", "d1"), ("d", 0, "1", "legend", "d1")], f"{key}, element string, deg string"))
    assert [r["element"] for r in kept.collect()] == ["axis"] and [tuple(r)[3:] for r in log.collect()] == [("title", "d1", "T")]
