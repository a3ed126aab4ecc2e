"""Comparators of operations that one side-by-side row cannot settle.

Their facts are child tables: cells, series, chart elements, diagram nodes, text runs, build steps,
page facts, layouts.  What a component damaged is rows too (``details``), so a plan with any mix of
operations is scored in one pass: each operation takes its components, brings the answer's and the
candidate's child rows to the key (scenario, deck, id) and hands them to its comparator.  The
candidate's rows come through the pairing, so a shape that changed its path keeps its children.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.operators import compare as X
from gradeloom.operators import matching as M

PAGE = ["scenario", "deck", "slide"]
SHAPE = [*PAGE, "path"]
ID = ["scenario", "deck", "id"]
#: Recorded fields of a build step, and of a run, that are compared.
STEP_FIELDS = ("cls", "preset", "subtype", "trigger_kind", "dur_ms")
RUN_FIELDS = ("font", "sz")

Pair = tuple[DataFrame, DataFrame]


@dataclass
class Facts:
    """Child tables: of each pair the answer's rows, and the candidates' rows with ``scenario`` and their own paths.

    ``details(deck, id, what, i, j, t, u)``: what a component damaged; ``what`` is cell (row i, column j), row, col (i), node
    (text t), series (name t), element (name t), paragraph (number i, action t), step (i), swap (pages i and j), cut (page
    i) or layout (name t, path u).  ``shapes`` are the page's shapes, for the order of pages.
    """

    details: DataFrame
    cells: Pair | None = None          # deck, slide, path, r, c, text
    series: Pair | None = None         # deck, slide, path, sno, sname, i, val, category
    elements: Pair | None = None       # deck, slide, path, element, value
    nodes: Pair | None = None          # deck, slide, path, t
    runs: Pair | None = None           # deck, slide, path, para, run, t, font, sz
    effects: Pair | None = None        # deck, slide, step, STEP_FIELDS
    pages: Pair | None = None          # deck, slide, notes, transition
    layouts: Pair | None = None        # deck, layout, path, kind, keys and box
    shapes: Pair | None = None         # deck, slide, path, plain


class Pass:
    """The components of one operation, ``asked(scenario, deck, slide, path, id)``, and the tables they read."""

    def __init__(self, asked: DataFrame, facts: Facts, counterparts: DataFrame):
        self.asked, self.facts, self.counterparts = asked, facts, counterparts

    def detail(self, what: str, **columns: str) -> DataFrame:
        own = self.facts.details.where(F.col("what") == what).select("deck", "id", *[F.col(c).alias(n) for n, c in columns.items()]).distinct()
        return self.asked.select(*ID).join(own, ["deck", "id"])

    def shape_rows(self, pair: Pair) -> Pair:
        """(wanted, found) child rows of the damaged shapes and of their counterparts, by component."""
        want, have = pair
        there = self.asked.join(self.counterparts, SHAPE).select(*ID, "slide", F.col("b_path").alias("path"))
        return (self.asked.join(want, ["deck", "slide", "path"]).drop("slide", "path"),
                there.join(have, SHAPE).drop("slide", "path"))

    def page_rows(self, pair: Pair) -> Pair:
        want, have = pair
        asked = self.asked.drop("path")
        return asked.join(want, ["deck", "slide"]).drop("slide"), asked.join(have, PAGE).drop("slide")


# ------------------------------------------------------------------ one function per operation

def _cells(p: Pass) -> DataFrame:
    want, have = p.shape_rows(p.facts.cells)
    return X.cleared_cells(want, have, p.detail("cell", r="i", c="j"), ID)


def _lines(axis: str, what: str) -> Callable[[Pass], DataFrame]:
    def run(p: Pass) -> DataFrame:
        want, have = p.shape_rows(p.facts.cells)
        return X.lines_restored(X.table_lines(want, axis, ID), X.table_lines(have, axis, ID), p.detail(what, no="i"), ID)
    return run


def _nodes(p: Pass) -> DataFrame:
    want, have = p.shape_rows(p.facts.nodes)
    return X.diagram_nodes(want, have, p.detail("node", t="t"), ID)


def _chart(p: Pass) -> DataFrame:
    want, have = p.shape_rows(p.facts.series)
    was, now = p.shape_rows(p.facts.elements)
    stripped = (p.detail("element", element="t").join(was, [*ID, "element"], "left")
                .join(now.withColumnRenamed("value", "__now"), [*ID, "element"], "left")
                .select(*ID, "element", F.col("value").eqNullSafe(F.col("__now")).alias("ok")))
    return X.chart_edit(want, have, p.detail("series", sname="t"), stripped, ID).select(*ID, "raw")


def _runs(p: Pass) -> DataFrame:
    want, have = p.shape_rows(p.facts.runs)

    def paragraphs(runs: DataFrame) -> DataFrame:
        words = F.transform(F.sort_array(F.collect_list(F.struct("run", "t"))), lambda x: x["t"])
        return runs.groupBy(*ID, "para").agg(F.concat_ws(" ", words).alias("t"))

    styles = X.run_properties(want, have, [*ID, "para"], RUN_FIELDS)
    return X.touched_paragraphs(p.detail("paragraph", para="i", action="t"), paragraphs(want), paragraphs(have), styles, ID)


def _steps(dropped: bool) -> Callable[[Pass], DataFrame]:
    def run(p: Pass) -> DataFrame:
        want, have = (X.step_signatures(rows, STEP_FIELDS, ID) for rows in p.page_rows(p.facts.effects))
        return X.animation_credit(want, have, p.detail("step", step="i") if dropped else None, ID)
    return run


def _page_text(name: str) -> Callable[[Pass], DataFrame]:
    def run(p: Pass) -> DataFrame:
        want, have = p.page_rows(p.facts.pages)
        rows = want.select(*ID, F.col(name).alias("__was")).join(have.select(*ID, F.col(name).alias("__now")), ID, "left")
        return rows.select(*ID, X.equal_text("__was", "__now").alias("raw"))
    return run


def _order(p: Pass) -> DataFrame:
    """Share of the displaced pages that can be told apart and are themselves again."""
    gt, frames = p.facts.shapes
    pages = gt.select("deck", "slide").distinct()
    swapped = p.detail("swap", a="i", b="j")
    swapped = swapped.select(*ID, F.col("a").alias("slide")).unionByName(swapped.select(*ID, F.col("b").alias("slide")))
    cut = p.detail("cut", a="i").groupBy(*ID).agg(F.min("a").alias("__from")).join(swapped.select(*ID), ID, "left_anti")
    behind = cut.join(pages, "deck").where(F.col("slide") >= F.col("__from")).select(*ID, "slide")
    moved = swapped.unionByName(behind).distinct()
    itself = page_itself(moved.select(*PAGE).distinct(), M.page_signatures(gt), M.page_signatures(frames, PAGE))
    there = frames.select(*PAGE).distinct().withColumn("__there", F.lit(True))
    return (moved.join(itself.where("judged"), PAGE).join(there, PAGE, "left").groupBy(*ID)
            .agg((F.count_if(F.col("itself") & F.col("__there")) / F.count(F.lit(1))).alias("raw")))


def _layout(p: Pass) -> DataFrame:
    """Share of the removed layout shapes that pair again, layouts addressed by name."""
    gt, frames = p.facts.layouts
    pairs = M.pair(gt, frames, ["scenario", "deck", "layout"], ["deck", "layout"])
    back = pairs.select("scenario", "deck", "layout", F.col("gt_path").alias("path"), F.lit(True).alias("__back"))
    removed = p.detail("layout", layout="t", path="u").join(gt.select("deck", "layout", "path"), ["deck", "layout", "path"], "left_semi")
    return removed.join(back, ["scenario", "deck", "layout", "path"], "left").groupBy(*ID).agg((F.count("__back") / F.count(F.lit(1))).alias("raw"))


def page_itself(asked: DataFrame, gt_marks: DataFrame, marks: DataFrame) -> DataFrame:
    """``matching.page_is_itself`` for ``asked(scenario, deck, slide)``, the scenario folded into the deck key."""
    def key(df: DataFrame) -> DataFrame:
        return df.withColumn("deck", F.concat_ws("\u0001", "scenario", "deck")).drop("scenario")

    names = asked.select("scenario").distinct()
    got = M.page_is_itself(key(asked), key(gt_marks.join(F.broadcast(names), how="cross")), key(marks))
    parts = F.split("deck", "\u0001")
    return got.select(F.element_at(parts, 1).alias("scenario"), F.element_at(parts, 2).alias("deck"), "slide", "itself", "judged")


#: Operation, the facts it needs, its comparator.
CHILD_OPS: dict[str, tuple[tuple[str, ...], Callable[[Pass], DataFrame]]] = {
    "clear_table_cells": (("cells",), _cells),
    "table_drop_rows": (("cells",), _lines("r", "row")),
    "table_drop_cols": (("cells",), _lines("c", "col")),
    "smartart_drop_nodes": (("nodes",), _nodes),
    "chart_edit": (("series", "elements"), _chart),
    "text_runs": (("runs",), _runs),
    "strip_animation": (("effects",), _steps(False)),
    "anim_drop_steps": (("effects",), _steps(True)),
    "strip_transition": (("pages",), _page_text("transition")),
    "clear_notes": (("pages",), _page_text("notes")),
    "reorder_slides": (("shapes",), _order),
    "delete_slides": (("shapes",), _order),
    "layout_edit": (("layouts",), _layout),
}


def child_raw(asked: DataFrame, facts: Facts, wide: DataFrame, ops: list[str]) -> DataFrame | None:
    """(scenario, deck, id, raw) of the operations in ``CHILD_OPS``; one whose facts are not given has no rows."""
    counterparts = wide.where(F.col("b_path").isNotNull()).select(*PAGE, F.col("a_path").alias("path"), "b_path")
    out = None
    for op in ops:
        needs, score = CHILD_OPS[op]
        if any(getattr(facts, n) is None for n in needs):
            continue
        own = asked.where(F.col("op") == op).select(*SHAPE, "id")
        part = score(Pass(own, facts, counterparts)).select(*ID, "raw")
        out = part if out is None else out.unionByName(part)
    return out


def content_scores(facts: Facts, wide: DataFrame) -> dict[str, DataFrame]:
    """Scores of whole tables, charts and diagrams by (scenario, deck, slide, path), as ``compare.restored`` reads them."""
    shapes = wide.select(*PAGE, F.col("a_path").alias("path"), "b_path", F.col("a_kind").alias("kind"))

    def both(kind: str, pair: Pair) -> Pair:
        own = shapes.where(F.col("kind") == kind).drop("kind")
        want, have = pair
        found = own.where(F.col("b_path").isNotNull()).withColumnRenamed("path", "__path").withColumnRenamed("b_path", "path")
        return own.drop("b_path").join(want, ["deck", "slide", "path"]), found.join(have, SHAPE).drop("path").withColumnRenamed("__path", "path")

    out = {}
    if facts.cells:
        out["table"] = X.table_cells(*both("table", facts.cells), keys=SHAPE)
    if facts.series:
        out["chart"] = X.series_credit(*both("chart", facts.series), keys=SHAPE)
    if facts.nodes:
        out["smartart"] = X.diagram_nodes(*both("smartart", facts.nodes), keys=SHAPE)
    return out
