"""Partial-credit comparators.

A comparator says how much of a damaged fact is right again, in [0, 1].  What cannot be decided is
null with a reason, and becomes 0 only when scores are folded.  Facets that need one row on each side
are columns over a_* (expected) and b_* (candidate); the others take child tables and join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.geometry import POS_TOL, ROT_TOL, inside
from gradeloom.functions.text import squeeze
from gradeloom.operators.matching import _fold
from gradeloom.session import put_down

SHAPE = ["deck", "slide", "path"]
# Numeric tolerance of chart values, depth of member roll-up.
CHART_TOL = 1e-12
MEMBER_DEPTH = 3


def a(name: str) -> Column:
    return F.col(f"a_{name}")


def b(name: str) -> Column:
    return F.col(f"b_{name}")


def present() -> Column:
    return F.col("b_path").isNotNull()


def same(name: str) -> Column:
    return a(name).eqNullSafe(b(name))


def credit(cond: Column) -> Column:
    """1 for yes, 0 for no or unknown."""
    return F.when(F.coalesce(cond, F.lit(False)), 1.0).otherwise(0.0)


def blend(parts: Sequence[tuple[float, Column]]) -> Column:
    """Weighted mean of the facets that apply; null when none does."""
    weight = sum((F.when(v.isNotNull(), float(w)).otherwise(0.0) for w, v in parts), F.lit(0.0))
    total = sum((F.coalesce(v, F.lit(0.0)) * float(w) for w, v in parts), F.lit(0.0))
    return F.when(weight > 0, total / F.nullif(weight, F.lit(0.0)))


def blend_rows(facets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Weighted mean over facet rows (keys, weight, value, label) with the reasons joined.

    A component has a handful of facets.
    """
    shown = F.concat("label", F.lit("="), F.format_string("%.2f", F.col("value")))
    per = facets.where(F.col("value").isNotNull()).groupBy(*keys).agg(
        (F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("raw"),
        F.array_sort(F.collect_list(shown)).alias("why"))
    return per.withColumn("why", F.concat_ws(" · ", "why"))


# ------------------------------------------------------------------ geometry

def geometry_credit(delta: Column, full: Column | int = POS_TOL, zero: Column | int | None = None) -> Column:
    """Exact within tolerance, or falling in a straight line from ``full`` to ``zero``."""
    if zero is None:
        return credit(delta <= full)
    full = F.greatest(F.lit(POS_TOL), full if isinstance(full, Column) else F.lit(full))
    zero = F.greatest(full + 1, zero if isinstance(zero, Column) else F.lit(zero))
    return F.when(delta <= full, 1.0).when(delta >= zero, 0.0).otherwise((zero - delta) / (zero - full))


def centre(**policy) -> Column:
    delta = F.greatest(F.abs(a("cx") - b("cx")), F.abs(a("cy") - b("cy")))
    return F.when(a("cx").isNotNull(), F.when(b("cx").isNull(), 0.0).otherwise(geometry_credit(delta, **policy)))


def extent(**policy) -> Column:
    """Width and height; only the width of a box that fits itself to its text."""
    wide = F.abs(a("w") - b("w"))
    delta = F.when(a("autofit"), wide).otherwise(F.greatest(wide, F.abs(a("h") - b("h"))))
    return F.when(a("w").isNotNull(), F.when(b("w").isNull(), 0.0).otherwise(geometry_credit(delta, **policy)))


def resize(**policy) -> Column:
    return blend([(3, extent(**policy)), (1, centre(**policy))])


def rotation() -> Column:
    turn = F.abs(F.pmod(a("rot") - b("rot") + 180.0, F.lit(360.0)) - 180.0)
    return F.when(a("rot").isNotNull(), credit(turn <= ROT_TOL))


# ------------------------------------------------------------------ style

def themed(rows: DataFrame, theme: DataFrame) -> DataFrame:
    """Attach a deck's colour names as one small map."""
    maps = theme.groupBy("deck").agg(F.map_from_entries(F.collect_list(F.struct(F.col("name"), F.col("value")))).alias("theme"))
    return rows.join(maps, "deck", "left")


def resolved(token: Column) -> Column:
    """A plain scheme colour as the deck's theme states it; anything with modifiers stays as it is."""
    name = F.lower(F.substring_index(token, ":", -1))
    plain = token.startswith("scheme:") & ~F.contains(token, F.lit("+"))
    rgb = F.when(F.col("theme").isNotNull(), F.try_element_at(F.col("theme"), name))
    return F.when(plain & rgb.isNotNull(), F.concat(F.lit("srgb:"), rgb)).otherwise(token)


def same_colour(name: str) -> Column:
    return same(name) | resolved(a(name)).eqNullSafe(resolved(b(name)))


def fill() -> Column:
    return credit(present() & same("fill_type") & same_colour("fill_color"))


def line() -> Column:
    return credit(present() & same("line_fill") & same("line_dash") & same_colour("line_color"))


def effects() -> Column:
    return F.when(a("effects").isNotNull(), credit(present() & same("effects")))


def geometry_preset() -> Column:
    return F.when(a("geom").isNotNull(), credit(present() & same("geom")))


def picture() -> Column:
    return F.when(a("blob").isNotNull(), credit(present() & same("blob")))


def crop() -> Column:
    return F.when(a("blob").isNotNull(), credit(present() & same("crop")))


def equation() -> Column:
    """Symbols and structure of a native equation; text that only looks like one earns nothing."""
    return F.when(a("eq_structure").isNotNull(), credit(b("eq_native") & same("eq_text") & same("eq_structure")))


# ------------------------------------------------------------------ order and groups

def zorder(components: DataFrame, wide: DataFrame) -> DataFrame:
    """Share of surviving peers on the right side, among the peers the move passed.

    ``components(deck, slide, path, to)``; each graded shape meets the shapes of its own page.
    """
    rows = wide.select("deck", "slide", F.col("a_path").alias("path"), F.col("a_z").alias("az"), F.col("b_z").alias("bz"),
                       F.coalesce("a_grp", F.lit("")).alias("parent"))
    mine = components.join(rows, SHAPE).select("deck", "slide", "path", "to", "parent", F.col("az").alias("my_az"), F.col("bz").alias("my_bz"))
    peers = rows.select("deck", "slide", "parent", F.col("path").alias("peer"), "az", "bz")
    met = mine.join(peers, ["deck", "slide", "parent"]).where(F.col("peer") != F.col("path"))
    met = met.where(F.when(F.col("to") == "back", F.col("az") < F.col("my_az"))
                    .when(F.col("to") == "front", F.col("az") > F.col("my_az")).otherwise(True))
    right = (F.col("my_bz") > F.col("bz")) == (F.col("my_az") > F.col("az"))
    per = met.groupBy(*SHAPE).agg(F.count("bz").alias("seen"), F.count_if(right).alias("hit"))
    raw = (F.when(F.col("my_bz").isNull(), 0.0)
           .when(F.coalesce("seen", F.lit(0)) > 0, F.col("hit") / F.nullif("seen", F.lit(0))))
    return mine.join(per, SHAPE, "left").select(*SHAPE, raw.alias("raw"))


def ungroup(wide: DataFrame) -> DataFrame:
    """Two parts for the group, three for the share of members whose counterpart sits in it."""
    groups = wide.where(F.col("a_kind") == "group").select(
        "deck", "slide", F.col("a_path").alias("path"), F.col("b_path").alias("now"), F.col("b_kind").alias("now_kind"))
    members = wide.where(F.col("a_grp").isNotNull()).select("deck", "slide", F.col("a_grp").alias("path"), F.col("b_grp").alias("in"))
    per = groups.join(members, SHAPE).groupBy(*SHAPE).agg(
        F.first("now_kind").alias("now_kind"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("in") == F.col("now")).alias("hit"))
    back = F.coalesce(F.col("now_kind") == "group", F.lit(False))
    return per.select(*SHAPE, F.when(back, (F.lit(2.0) + F.col("hit") * 3.0 / F.col("n")) / 5.0).otherwise(0.0).alias("raw"))


# ------------------------------------------------------------------ multisets of text

def recalled(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, want, hit, raw) of ``counts(keys, nw, nh)``: how often each text is wanted and there."""
    per = counts.where(F.col("nw") > 0).groupBy(*keys).agg(F.sum("nw").alias("want"), F.sum(F.least("nw", "nh")).alias("hit"))
    return per.withColumn("raw", F.col("hit") / F.col("want"))


def multiset_recall(want: DataFrame, have: DataFrame, keys: Sequence[str], text: str = "t") -> DataFrame:
    """(keys, want, hit, raw): how many wanted texts are there, each occurrence used once."""
    rows = want.select(*keys, text, F.lit(1).alias("w")).unionByName(have.select(*keys, text, F.lit(0).alias("w")))
    return recalled(rows.groupBy(*keys, text).agg(F.count_if(F.col("w") == 1).alias("nw"), F.count_if(F.col("w") == 0).alias("nh")), keys)


def rebuilt_composite(composites: DataFrame, words: DataFrame, loose: DataFrame) -> DataFrame:
    """Words of a lost composite found in unmatched boxes inside its place; a box counts once.

    ``composites`` has b_cx.. of the place as region_*, ``loose`` unmatched shapes with text.
    """
    boxes = loose.select("deck", "slide", squeeze(F.col("plain")).alias("t"), *[F.col(c).alias(f"a_{c}") for c in ("cx", "cy", "w", "h")])
    place = composites.select(*SHAPE, *[F.col(c).alias(f"r_{c}") for c in ("cx", "cy", "w", "h")])
    wanted = words.select(*SHAPE, squeeze(F.col("t")).alias("t")).where(F.col("t") != "").groupBy(*SHAPE, "t").agg(F.count(F.lit(1)).alias("nw"))
    near = wanted.join(place, SHAPE).join(boxes, ["deck", "slide", "t"], "left").withColumn("in", inside("a_", "r_"))
    return recalled(near.groupBy(*SHAPE, "t").agg(F.min("nw").alias("nw"), F.count_if("in").alias("nh")), SHAPE)


# ------------------------------------------------------------------ runs

def run_properties(want: DataFrame, have: DataFrame, keys: Sequence[str], props: Sequence[str],
                   at: str = "run", per: Sequence[str] | None = None) -> DataFrame:
    """(per, stated, hit, raw): run properties the answer states, paired by words, else by index.

    A run whose index holds the same words pairs there; otherwise the first run with its words, and
    failing that the run at its index.  Properties the answer leaves open are not counted.
    """
    mine = have.select(*keys, F.col(at).alias("__at"), F.col("t").alias("__t"), F.struct(*props).alias("__p"))
    by_index = mine.select(*keys, F.col("__at").alias(at), F.col("__t").alias("__it"), F.col("__p").alias("__ip"))
    by_word = mine.groupBy(*keys, F.col("__t").alias("t")).agg(F.min_by("__p", "__at").alias("__wp"))
    rows = want.join(by_index, [*keys, at], "left").join(by_word, [*keys, "t"], "left")
    peer = F.when(F.col("__it").eqNullSafe(F.col("t")), F.col("__ip")).otherwise(F.coalesce("__wp", "__ip"))
    rows = rows.withColumn("__peer", peer)
    stated = sum((F.col(p).isNotNull().cast("int") for p in props), F.lit(0))
    hit = sum((F.coalesce(F.col(p).isNotNull() & (F.col(f"__peer.{p}") == F.col(p)), F.lit(False)).cast("int") for p in props), F.lit(0))
    out = rows.groupBy(*(per or keys)).agg(F.sum(stated).alias("stated"), F.sum(hit).alias("hit"))
    return out.withColumn("raw", F.when(F.col("stated") > 0, F.col("hit") / F.nullif("stated", F.lit(0))))


def touched_paragraphs(touched: DataFrame, gt_paras: DataFrame, have_paras: DataFrame, styles: DataFrame,
                       keys: Sequence[str]) -> DataFrame:
    """Score only paragraphs a step touched: presence where it was deleted, style where restyled.

    ``touched(keys, para, action)``, paragraphs ``(keys, para, t)``, ``styles(keys, para, raw)`` from
    ``run_properties``.
    """
    want = touched.join(gt_paras, [*keys, "para"])
    there = have_paras.select(*keys, "t").distinct().withColumn("__there", F.lit(True))
    rows = want.join(there, [*keys, "t"], "left").join(styles.select(*keys, "para", F.col("raw").alias("__style")), [*keys, "para"], "left")
    gone = F.col("action").isin("deleted", "emptied")
    score = F.when(gone, credit(F.coalesce("__there", F.lit(False)) & (F.col("t") != ""))).otherwise(F.col("__style"))
    per = rows.withColumn("__s", score).groupBy(*keys).agg(F.count("__s").alias("judged"), F.sum("__s").alias("earned"))
    return per.withColumn("raw", F.when(F.col("judged") > 0, F.col("earned") / F.nullif("judged", F.lit(0))))


# ------------------------------------------------------------------ connectors

def connector_ends(lines: DataFrame, wide: DataFrame, ends: Sequence[str] = ("start", "end")) -> DataFrame:
    """Share of detached ends that hold the counterpart of the shape they held before."""
    ids = wide.select("deck", "slide", F.col("a_shape_id").alias("__ga"), F.col("b_shape_id").alias("__gb"))
    rows = lines.withColumn("__hit", F.lit(0))
    for end in ends:
        link = ids.select("deck", "slide", F.col("__ga").alias(f"a_{end}_id"), F.col("__gb").alias("__want"))
        rows = rows.join(link, ["deck", "slide", f"a_{end}_id"], "left")
        both_free = a(f"{end}_id").isNull() & b(f"{end}_id").isNull()
        rows = rows.withColumn("__hit", F.col("__hit") + F.coalesce(both_free | (F.col("__want") == b(f"{end}_id")), F.lit(False)).cast("int")).drop("__want")
    return rows.select("deck", "slide", F.col("a_path").alias("path"), (F.col("__hit") / len(ends)).alias("raw"))


# ------------------------------------------------------------------ tables

def table_cells(want: DataFrame, have: DataFrame, keys: Sequence[str] = SHAPE) -> DataFrame:
    """Share of non-empty cells that read the same; a table of another shape earns nothing."""
    size = lambda df, n: df.groupBy(*keys).agg(F.max("r").alias(f"{n}r"), F.max("c").alias(f"{n}c"))
    cells = want.where(F.col("text") != "").select(*keys, "r", "c", "text").join(
        have.select(*keys, "r", "c", F.col("text").alias("now")), [*keys, "r", "c"], "left")
    per = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("text") == F.col("now")).alias("hit"))
    shape = size(want, "w").join(size(have, "h"), keys, "left")
    fits = F.coalesce((F.col("wr") == F.col("hr")) & (F.col("wc") == F.col("hc")), F.lit(False))
    return shape.join(per, keys, "left").select(*keys, F.when(fits, F.coalesce(F.col("hit") / F.col("n"), F.lit(0.0))).otherwise(0.0).alias("raw"))


def cleared_cells(want: DataFrame, have: DataFrame, cleared: DataFrame, keys: Sequence[str] = SHAPE) -> DataFrame:
    """Share of cleared cells back; nothing when a cell that was left alone has changed."""
    rows = (want.select(*keys, "r", "c", "text").join(cleared.withColumn("__cleared", F.lit(True)), [*keys, "r", "c"], "left")
            .join(have.select(*keys, "r", "c", F.col("text").alias("now")), [*keys, "r", "c"], "left"))
    hit = F.coalesce(F.col("text") == F.col("now"), F.lit(False))
    lost = F.col("__cleared").isNull() & (F.col("text") != "") & ~hit
    per = rows.groupBy(*keys).agg(F.count("__cleared").alias("n"), F.count_if(F.col("__cleared") & hit).alias("hit"), F.bool_or(lost).alias("lost"))
    return per.where(F.col("n") > 0).select(*keys, F.when(F.col("lost"), 0.0).otherwise(F.col("hit") / F.col("n")).alias("raw"))


def table_lines(cells: DataFrame, axis: str, keys: Sequence[str] = SHAPE) -> DataFrame:
    """Rows or columns of a table as one text each: (keys, no, content); a line is a few cells."""
    other = "c" if axis == "r" else "r"
    return cells.groupBy(*keys, F.col(axis).alias("no")).agg(
        F.concat_ws("|", F.transform(F.array_sort(F.collect_list(F.struct(other, "text"))), lambda x: x["text"])).alias("content"))


def lines_restored(want: DataFrame, have: DataFrame, dropped: DataFrame, keys: Sequence[str] = SHAPE) -> DataFrame:
    """Dropped lines back in place: k-th copies pair, order must hold and survivors must be there."""
    blank = F.regexp_replace("content", r"\|", "") == ""
    nth = F.row_number().over(Window.partitionBy(*keys, "content").orderBy("no"))
    w = want.where(~blank).withColumn("k", nth)
    h = have.where(~blank).withColumn("k", nth).withColumnRenamed("no", "now")
    rows = w.join(h, [*keys, "content", "k"], "left").join(dropped.withColumn("__dropped", F.lit(True)), [*keys, "no"], "left")
    order = Window.partitionBy(*keys).orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__before", F.last("now", ignorenulls=True).over(order))
    per = rows.groupBy(*keys).agg(
        F.count("__dropped").alias("asked"), F.count_if(F.col("__dropped") & F.col("now").isNotNull()).alias("hit"),
        F.bool_or(F.coalesce(F.col("now") < F.col("__before"), F.lit(False))).alias("swapped"),
        F.bool_or(F.col("__dropped").isNull() & F.col("now").isNull()).alias("lost"))
    return per.where(F.col("asked") > 0).select(*keys, F.when(F.col("swapped") | F.col("lost"), 0.0).otherwise(F.col("hit") / F.col("asked")).alias("raw"))


def diagram_nodes(want: DataFrame, have: DataFrame, removed: DataFrame | None = None, keys: Sequence[str] = SHAPE) -> DataFrame:
    """Node texts that are back; with ``removed``, only those, and only if all the others are there."""
    there = have.select(*keys, "t").distinct().withColumn("__there", F.lit(True))
    rows = want.where(F.col("t") != "").join(there, [*keys, "t"], "left").withColumn("__there", F.coalesce("__there", F.lit(False)))
    if removed is None:
        return rows.groupBy(*keys).agg((F.count_if("__there") / F.count(F.lit(1))).alias("raw"))
    rows = rows.join(removed.select(*keys, "t").distinct().withColumn("__gone", F.lit(True)), [*keys, "t"], "left")
    per = rows.groupBy(*keys).agg(F.count("__gone").alias("n"), F.count_if(F.col("__gone") & F.col("__there")).alias("hit"),
                                  F.bool_or(F.col("__gone").isNull() & ~F.col("__there")).alias("lost"))
    return per.where(F.col("n") > 0).select(*keys, F.when(F.col("lost"), 0.0).otherwise(F.col("hit") / F.col("n")).alias("raw"))


# ------------------------------------------------------------------ charts

def close_numbers(x: Column, y: Column) -> Column:
    scale = F.greatest(F.abs(x), F.abs(y)) * CHART_TOL
    return F.coalesce(F.abs(x - y) <= F.greatest(scale, F.lit(CHART_TOL)), F.lit(False))


def series_credit(want: DataFrame, have: DataFrame, keys: Sequence[str] = SHAPE) -> DataFrame:
    """(keys, raw): series paired one to one by name and best value; surplus on either side costs.

    ``want`` and ``have`` are points (keys, sno, sname, i, val, category).  A chart has few series.
    """
    def sizes(df: DataFrame, n: str) -> DataFrame:
        return df.groupBy(*keys, F.col("sno").alias(f"{n}_sno"), F.col("sname").alias("sname")).agg(F.count(F.lit(1)).alias(f"{n}_n"))

    w, h = sizes(want, "w"), sizes(have, "h")
    cand = w.join(h, [*keys, "sname"])
    pts = (want.select(*keys, F.col("sno").alias("w_sno"), "sname", "i", F.col("val").alias("wv"), F.col("category").alias("wc"))
           .join(have.select(*keys, F.col("sno").alias("h_sno"), "sname", "i", F.col("val").alias("hv"), F.col("category").alias("hc")), [*keys, "sname", "i"]))
    hits = pts.groupBy(*keys, "w_sno", "h_sno").agg(
        F.count_if(close_numbers(F.col("wv"), F.col("hv"))).alias("v"), F.count_if(squeeze(F.col("wc")) == squeeze(F.col("hc"))).alias("c"))
    most = F.greatest("w_n", "h_n")
    value = (F.coalesce("v", F.lit(0)) / most * 3.0 + F.coalesce("c", F.lit(0)) / most + 1.0) / 5.0
    scored = cand.join(hits, [*keys, "w_sno", "h_sno"], "left").withColumn("value", value)
    props = scored.select(*keys, F.col("w_sno").cast("string").alias("gt_path"), F.col("h_sno").cast("string").alias("other_path"),
                          F.col("w_sno").alias("first"), (-F.col("value")).alias("second"), (-F.col("h_sno")).alias("third"),
                          F.col("value").cast("string").alias("key"), F.lit(True).alias("strong"))
    got = _fold(props, list(keys), ["first", "second", "third", "gt_path", "other_path"])
    earned = got.groupBy(*keys).agg(F.sum(F.col("key").cast("double")).alias("earned"))
    total = (w.groupBy(*keys).agg(F.count(F.lit(1)).alias("nw"))
             .join(h.groupBy(*keys).agg(F.count(F.lit(1)).alias("nh")), keys, "left").join(earned, keys, "left"))
    return total.select(*keys, (F.coalesce("earned", F.lit(0.0)) / F.greatest("nw", F.coalesce("nh", F.lit(0)))).alias("raw"))


def chart_credit(series: DataFrame, furniture: DataFrame, keys: Sequence[str] = SHAPE) -> DataFrame:
    """Series 5, plot 2, axes 2, presentation 1; ``furniture(keys, plot, axes, presentation)``; with the credit of the series alone."""
    rows = series.join(furniture, keys, "left")
    value = blend([(5, F.col("raw")), (2, F.coalesce("plot", F.lit(0.0))), (2, F.coalesce("axes", F.lit(0.0))), (1, F.coalesce("presentation", F.lit(0.0)))])
    return rows.select(*keys, value.alias("raw"), F.col("raw").alias("series"))


def chart_edit(want: DataFrame, have: DataFrame, dropped: DataFrame, stripped: DataFrame, keys: Sequence[str] = SHAPE) -> DataFrame:
    """Dropped series back exactly with survivors kept (3), and each stripped element back (1).

    ``stripped(keys, element, ok)``.
    """
    pts = (want.select(*keys, "sname", "i", "val").join(have.select(*keys, "sname", "i", F.col("val").alias("now")), [*keys, "sname", "i"], "left")
           .groupBy(*keys, "sname").agg(F.bool_and(close_numbers(F.col("val"), F.col("now"))).alias("exact")))
    rows = pts.join(dropped.withColumn("__d", F.lit(True)), [*keys, "sname"], "left")
    per = rows.groupBy(*keys).agg(F.count("__d").alias("n"), F.count_if(F.col("__d") & F.col("exact")).alias("hit"),
                                  F.bool_or(F.col("__d").isNull() & ~F.col("exact")).alias("lost"))
    series = per.where(F.col("n") > 0).select(*keys, F.lit(3.0).alias("weight"), F.when(F.col("lost"), 0.0).otherwise(F.col("hit") / F.col("n")).alias("value"), F.lit("series").alias("label"))
    parts = stripped.select(*keys, F.lit(1.0).alias("weight"), credit(F.col("ok")).alias("value"), F.col("element").alias("label"))
    return blend_rows(series.unionByName(parts), keys)


# ------------------------------------------------------------------ animation, transitions, notes

def step_signatures(effects: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("deck", "slide")) -> DataFrame:
    """(keys, step, sig): the effects of one build step, in any order, as text; a step is a few effects."""
    one = F.concat_ws("/", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    return effects.groupBy(*keys, "step").agg(F.concat_ws(",", F.array_sort(F.collect_list(one))).alias("sig"))


def animation_credit(want: DataFrame, have: DataFrame, removed: DataFrame | None = None, keys: Sequence[str] = ("deck", "slide")) -> DataFrame:
    """Steps equal in place; a wrong number of steps keeps 0.75, or 0.5 when single steps were dropped."""
    keys = list(keys)
    rows = want.join(have.select(*keys, "step", F.col("sig").alias("now")), [*keys, "step"], "left")
    if removed is not None:
        rows = rows.join(removed.withColumn("__asked", F.lit(True)), [*keys, "step"], "left")
    else:
        rows = rows.withColumn("__asked", F.lit(True))
    hit = F.col("__asked") & F.coalesce(F.col("sig") == F.col("now"), F.lit(False))
    per = rows.groupBy(*keys).agg(F.count("__asked").alias("n"), F.count_if(hit).alias("hit"), F.count(F.lit(1)).alias("steps"))
    count = have.groupBy(*keys).agg(F.count(F.lit(1)).alias("now_steps"))
    exact = F.coalesce("now_steps", F.lit(0)) == F.col("steps")
    share = F.when(exact, 1.0).otherwise(0.75 if removed is None else 0.5)
    return per.where(F.col("n") > 0).join(count, keys, "left").select(*keys, (F.col("hit") / F.col("n") * share).alias("raw"))


def equal_text(expected: str, now: str) -> Column:
    """Notes or a transition: equal or not; nothing to restore is undecidable."""
    return F.when(squeeze(F.col(expected)) != "", credit(squeeze(F.col(expected)) == squeeze(F.col(now))))


def slide_order(displaced: DataFrame, itself: DataFrame) -> DataFrame:
    """Share of displaced pages that can be told apart and are themselves again."""
    return (displaced.join(itself.where("judged"), ["deck", "slide"]).groupBy("deck")
            .agg((F.count_if("itself") / F.count(F.lit(1))).alias("raw")))


def displaced_pages(edits: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages a swap names, or every page from the first deleted one on."""
    swaps = edits.where(F.col("kind") == "swap").select("deck", F.explode(F.array("a", "b")).alias("slide"))
    cut = edits.where(F.col("kind") == "delete").groupBy("deck").agg(F.min("a").alias("from"))
    behind = pages.join(cut, "deck").join(swaps.select("deck"), "deck", "left_anti").where(F.col("slide") >= F.col("from")).select("deck", "slide")
    return swaps.unionByName(behind).distinct()


# ------------------------------------------------------------------ restored shapes

def restored(wide: DataFrame, content: dict[str, DataFrame], depth: int = MEMBER_DEPTH,
             keys: Sequence[str] = ("deck", "slide")) -> DataFrame:
    """The shape has to be back: what it is, times where it is.

    ``wide`` has the theme map; ``content`` gives scores of shapes with a table, a chart or a diagram
    as (keys, path, raw).  A pairing on a weak key counts only where the position is right.
    Members of a container are scored first and averaged into it, level by level; ``depth`` is how
    deep containers nest, at most three levels count.
    """
    rows = wide
    for name, scores in content.items():
        rows = rows.join(scores.select(*keys, F.col("path").alias("a_path"), F.col("raw").alias(f"s_{name}")), [*keys, "a_path"], "left")
    rows = rows.withColumns({"__placed": centre(), "__extent": extent(), "__pic": picture(), "__fill": F.when(a("fill_type").isNotNull(), fill()),
                             "__words": F.when(a("plain") != "", credit(squeeze(a("plain")) == squeeze(b("plain")))),
                             "__geom": geometry_preset(), "__line": F.when(a("line_fill").isNotNull(), line()), "__fx": effects(),
                             "__family": F.coalesce("a_grp", "a_path")})
    own = [(3, F.col("__pic")), (3, F.col("__words")), (1, F.col("__fill"))]
    own += [(3, F.when(a("kind") == kind, F.coalesce(F.col(f"s_{kind}"), F.lit(0.0)))) for kind in content]
    look = [(1, F.col("__geom")), (1, F.col("__line")), (1, F.col("__fx"))]
    rows = rows.withColumns({"__own": blend(own), "__where": blend([(2, F.col("__placed")), (1, F.col("__extent"))]),
                             "__known": F.coalesce(F.col("strong"), F.lit(False)) | (F.coalesce("__placed", F.lit(0.0)) > 0)})

    def total(members: Column | None) -> Column:
        identity = blend(look if members is None else [(3, members), *look])
        what = F.coalesce(F.col("__own"), identity)
        whole = F.coalesce(what, F.lit(1.0)) * F.coalesce("__where", F.lit(1.0))
        missing = F.lit(0.0) if members is None else F.coalesce(members, F.lit(0.0))
        return F.when(~present(), missing).when(~F.col("__known"), 0.0).otherwise(whole)

    rows = rows.withColumn("raw", total(None))
    if depth == 1:
        # a container and its members share a family, so their roll-up is one window and no self-join
        family = Window.partitionBy(*keys, "__family")
        kids = F.when(F.col("a_path") == F.col("__family"), F.avg(F.when(F.col("a_grp").isNotNull(), F.col("raw"))).over(family))
        rows = rows.withColumn("__kids", kids).withColumn("raw", total(F.col("__kids")))
    else:
        # what a roll-up reads, written once; a level joins only the containers, and none is left for it once nesting ends
        rows = put_down(rows.select(*keys, "a_path", "a_grp", "b_path", "__known", "__own", "__where", "__geom", "__line", "__fx", "raw"))
        inner = rows.where(F.col("a_grp").isNotNull())
        for _ in range(min(depth, MEMBER_DEPTH)):
            kids = inner.groupBy(*keys, F.col("a_grp").alias("a_path")).agg(F.avg("raw").alias("__kids"))
            tops = put_down(rows.drop("raw").join(kids, [*keys, "a_path"]).withColumn("raw", total(F.col("__kids"))).drop("__kids"))
            rows = rows.join(tops.select(*keys, "a_path", F.col("raw").alias("__new")), [*keys, "a_path"], "left").withColumn(
                "raw", F.coalesce("__new", "raw")).drop("__new")
            if tops.where(F.col("a_grp").isNotNull()).isEmpty():
                break
            rows = put_down(rows)
            inner = rows.where(F.col("a_grp").isNotNull())
    return rows.select(*keys, F.col("a_path").alias("path"), "raw")
