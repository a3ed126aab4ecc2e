"""Plans, gates, scope penalties and the final score.

Everything is keyed by (scenario, deck[, slide]) so that any number of candidates of any number of
decks is scored in one pass.  ``plan`` tables are components, regions and findings.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.geometry import covers, inside, same_place
from gradeloom.functions.text import squeeze
from gradeloom.operators import compare as X
from gradeloom.operators import matching as M
from gradeloom.operators.graded import CHILD_OPS, Facts, child_raw, content_scores, page_itself
from gradeloom.operators.structure import is_strong
from gradeloom.session import put_down

PAGE = ["scenario", "deck", "slide"]

# Limits, rates and the order of the gates.
FLOOR_LIMIT = 0.15
STEP_DISAGREEMENT = 3.0
DECLARATION_SPLIT = 0.25
OVERLAY_COVER = 0.80
NATIVE_KINDS = ("chart", "table", "smartart")
SCOPE_RATES = {"untouched_pages_unchanged": (0.10, 0.30), "survivors_intact": (0.06, 0.30),
               "no_extra_shapes": (0.04, 0.20), "input_media_preserved": (0.15, 0.15)}
PENALTY_CAP = 0.50
GATES = ("plan_accepted", "slide_count_and_order", "no_full_page_overlay", "native_objects_preserved",
         "no_cloned_shapes", "media_not_pasted")


# ------------------------------------------------------------------ plan

def number_components(entries: DataFrame) -> DataFrame:
    """Stable ids in (slide, entry) order within each deck's plan."""
    order = Window.partitionBy("deck").orderBy("slide", "rn", "op")
    number = F.row_number().over(order)
    return entries.withColumn("id", F.concat(F.lit("c"), F.lpad(number.cast("string"), 6, "0")))


def damage_regions(entries: DataFrame) -> DataFrame:
    """(deck, slide, path, cx, cy, w, h) of every entry, scored or not."""
    return entries.select("deck", "slide", F.col("gt_path").alias("path"), "cx", "cy", "w", "h").distinct()


def split_satisfiable(components: DataFrame, gt_scores: DataFrame) -> DataFrame:
    """Add ``scoreable``: the ground truth itself earns the component in full."""
    own = gt_scores.select("deck", "id", F.col("raw").alias("__gt"))
    return components.join(own, ["deck", "id"], "left").withColumn(
        "scoreable", F.coalesce(F.col("__gt") >= 1.0 - 1e-9, F.lit(False))).drop("__gt")


def traceability(components: DataFrame, degradations: DataFrame) -> DataFrame:
    """Findings where components and declared degradations do not cover each other."""
    declared = degradations.select("deck", "deg").distinct()
    named = components.where(F.col("deg").isNotNull()).select("deck", "deg").distinct()

    def finding(rows: DataFrame, check: str) -> DataFrame:
        return rows.select("deck", F.lit(check).alias("check"), F.col("deg").alias("key"))

    return (finding(components.where(F.col("deg").isNull()).select("deck", "deg").distinct(), "component without degradation")
            .unionByName(finding(named.join(declared, ["deck", "deg"], "left_anti"), "unknown degradation"))
            .unionByName(finding(declared.join(named, ["deck", "deg"], "left_anti"), "degradation with no component"))
            .unionByName(finding(degradations.where(F.coalesce("est_steps", F.lit(0)) <= 0), "no step estimate")))


# How a step figure is marked in prose.
STEP_FIGURE = r"(?i)\b(d[0-9]+)\b[^~0-9]*?(?:~\s*|\b(?:about|roughly|around|approximately)\s+)([0-9]+)"


def measured_steps(notes: DataFrame, degradations: DataFrame, totals: DataFrame) -> DataFrame:
    """(deck, deg, measured, usable): structured figures first, else figures marked as such in prose.

    All declared degradations must have one and the sum must agree with the stated total; a deck that
    fails keeps its figures but they may not be weighted by.
    """
    said = (notes.select("deck", F.explode(F.regexp_extract_all("text", F.lit(STEP_FIGURE), F.lit(0))).alias("hit"))
            .select("deck", F.lower(F.regexp_extract("hit", STEP_FIGURE, 1)).alias("deg"),
                    F.regexp_extract("hit", STEP_FIGURE, 2).try_cast("long").alias("prose"))
            .groupBy("deck", "deg").agg(F.min("prose").alias("prose")))
    rows = degradations.select("deck", "deg", F.col("measured").alias("structured")).join(said, ["deck", "deg"], "left")
    full = rows.groupBy("deck").agg(F.bool_and(F.col("structured").isNotNull()).alias("__s"), F.bool_and(F.col("prose").isNotNull()).alias("__p"))
    rows = rows.join(full, "deck").withColumn("figure", F.when(F.col("__s"), F.col("structured")).when(F.col("__p"), F.col("prose"))
                                              .otherwise(F.coalesce("structured", "prose")))
    sums = rows.groupBy("deck").agg(F.sum("figure").alias("__sum")).join(totals, "deck", "left")
    agrees = F.coalesce(F.abs(F.col("__sum") - F.col("total")) / F.nullif("total", F.lit(0)) <= DECLARATION_SPLIT, F.lit(False))
    return rows.join(sums, "deck").select("deck", "deg", F.col("figure").alias("measured"), ((F.col("__s") | F.col("__p")) & agrees).alias("usable"))


def step_disagreement(degradations: DataFrame) -> DataFrame:
    """(deck, worst, refused): largest ratio between declared and measured steps.

    Refused only where the measurement may not be weighted by.
    """
    known = (F.col("est_steps") > 0) & (F.col("measured") > 0)
    ratio = F.when(known, F.bround(F.greatest("est_steps", "measured") / F.least("est_steps", "measured"), 3))
    return degradations.groupBy("deck").agg(F.max(ratio).alias("worst"), F.bool_or("usable").alias("__u")).select(
        "deck", "worst", (~F.col("__u") & (F.col("worst") > STEP_DISAGREEMENT)).alias("refused"))


def component_weights(components: DataFrame, degradations: DataFrame) -> DataFrame:
    """Share of a degradation by its steps, times the part of it that can be scored, split evenly.

    ``components`` has ``scoreable``; unscoreable ones lower their degradation's share and leave.
    Where steps are missing every component weighs the same.
    """
    members = Window.partitionBy("deck", "deg")
    rows = components.withColumn("__all", F.count(F.lit(1)).over(members)).withColumn(
        "__alive", F.sum(F.col("scoreable").cast("int")).over(members))
    rows = rows.where("scoreable").join(degradations.select("deck", "deg", "steps"), ["deck", "deg"], "left")
    deck = Window.partitionBy("deck")
    known = F.min(F.coalesce((F.col("steps") > 0).cast("int"), F.lit(0))).over(deck) == 1
    share = F.col("steps") * (F.col("__alive") / F.col("__all")) / F.col("__alive")
    rows = rows.withColumn("__known", known).withColumn("__w", F.when(F.col("__known"), share).otherwise(1.0))
    total = F.sum("__w").over(deck)
    return (rows.withColumn("weight", F.col("__w") / total)
            .withColumn("weight_source", F.when(F.col("__known"), "steps").otherwise("equal"))
            .drop("__all", "__alive", "__known", "__w", "steps"))


def declaration_split(tasks: DataFrame, degradations: DataFrame) -> DataFrame:
    """Headline steps against the sum of the parts; beyond a quarter of the headline they contradict."""
    parts = degradations.groupBy("deck").agg(F.sum("est_steps").alias("parts"))
    return tasks.join(parts, "deck").select(
        "deck", "est_total", "parts",
        (F.abs(F.col("parts") - F.col("est_total")) / F.nullif("est_total", F.lit(0)) > DECLARATION_SPLIT).alias("refused"))


def high_floors(scores: DataFrame) -> DataFrame:
    """Components the broken file already satisfies beyond the limit."""
    return scores.where(F.col("floor") > FLOOR_LIMIT).select("deck", "id", "op", F.bround("floor", 6).alias("floor"))


def duplicate_components(components: DataFrame, spec: Sequence[str]) -> DataFrame:
    """Components equal in operation, place and parameters to an earlier one."""
    same = Window.partitionBy("deck", "op", "slide", "gt_path", *spec)
    return (components.withColumn("first_id", F.min("id").over(same))
            .where(F.col("id") != F.col("first_id")).select("deck", "id", "first_id"))


# ------------------------------------------------------------------ component scores

def _same_words() -> Column:
    """Share of the answer's words, with repeats, that the candidate's text holds."""
    want, have = (F.filter(F.split(squeeze(F.col(c)), " "), lambda x: x != "") for c in ("a_plain", "b_plain"))
    have = F.coalesce(have, F.array().cast("array<string>"))
    hit = F.aggregate(F.array_distinct(want), F.lit(0), lambda acc, w: acc + F.least(F.size(F.filter(want, lambda x: x == w)), F.size(F.filter(have, lambda x: x == w))))
    return F.when(F.size(want) > 0, hit / F.size(want)).otherwise(X.credit(F.size(have) == 0))


def row_comparators(ops: Sequence[str]) -> dict[str, tuple[Column, tuple[str, ...]]]:
    """Credit by operation, for operations that one side-by-side row settles, and the facts it reads."""
    def stated(*names: str) -> Column:
        return X.blend([(1.0, F.when(X.a(c).isNotNull(), X.credit(X.present() & X.same(c)))) for c in names])

    box = ("cx", "cy")
    made = [
        (("move", "scatter", "swap"), X.centre, box),
        (("resize",), X.resize, (*box, "w", "h", "autofit")),
        (("rotate",), X.rotation, ("rot",)),
        (("recolor",), lambda: F.when(X.a("fill_type").isNotNull(), X.fill()), ("fill_type", "fill_color")),
        (("outline",), X.line, ("line_fill", "line_dash", "line_color")),
        (("strip_effects",), lambda: X.blend([(1.0, X.effects()), (1.0, X.fill())]), ("effects", "fill_type", "fill_color")),
        (("clear_text", "set_text"), _same_words, ("plain",)),
        (("set_font",), lambda: stated("font", "sz", "bold"), ("font", "sz", "bold")),
        (("crop", "swap_picture"), lambda: X.blend([(1.0, X.picture()), (1.0, X.crop())]), ("blob", "crop")),
        (("drop_equation",), X.equation, ("eq_native", "eq_text", "eq_structure")),
        (("detach_connector",), lambda: stated("start_id", "end_id"), ("start_id", "end_id")),
    ]
    return {op: (build(), facts) for names, build, facts in made for op in names if op in ops}


#: Operations whose credit is the return of whole shapes, and those that need a page's other shapes.
RETURN_OPS = ("delete", "blank_slide")
PAGE_OPS = ("zorder", "ungroup")
SCORED_OPS = (*RETURN_OPS, *PAGE_OPS, "move", "scatter", "swap", "resize", "rotate", "recolor", "outline", "strip_effects", "clear_text", "set_text",
              "set_font", "crop", "swap_picture", "drop_equation", "detach_connector", *CHILD_OPS)


def component_raw(components: DataFrame, wide: DataFrame, content: dict[str, DataFrame] | None = None, ops: Sequence[str] = SCORED_OPS,
                  facts: Facts | None = None, depth: int = 1, scenarios: DataFrame | None = None, whole: DataFrame | None = None) -> DataFrame:
    """(scenario, deck, id, op, raw): every component of every scenario by the comparator of its operation.

    ``wide`` has one row per (scenario, shape).  ``ops`` names the operations a plan can hold, so that only
    their comparators and columns are read.  Drawing order reads ``to`` of its components, if they have it; operations on child tables
    need ``facts``.  ``whole`` are the rows of ``wide`` that the return of whole shapes is judged by, if known.  A component that no comparator can decide, of an unknown operation too, keeps its row with a null
    ``raw``, so a deck's weights always add up.
    """
    names = wide.select("scenario").distinct() if scenarios is None else scenarios
    to = F.col("to") if "to" in components.columns else F.lit(None).cast("string")
    own = components.select("deck", "slide", F.col("gt_path").alias("path"), "id", "op", to.alias("to"))
    asked = own.join(F.broadcast(names), how="cross")                  # a handful of named scenarios
    settled = {op: x for op, x in row_comparators(ops).items() if {f"a_{c}" for c in x[1]} <= set(wide.columns)}
    returned, paged = ([op for op in ops if op in some] for some in (RETURN_OPS, PAGE_OPS))
    children = [op for op in ops if op in CHILD_OPS] if facts else []
    out = ["scenario", "deck", "id", "op", "raw"]

    read = {f"{side}_{c}" for _, needs in settled.values() for c in needs for side in "ab"} | ({"b_path", "theme"} if settled else set())
    rows = asked.where(~F.col("op").isin(*returned, *paged, *children))
    if settled:
        rows = rows.join(wide.select(*PAGE, F.col("a_path").alias("path"), F.lit(True).alias("__there"), *sorted(read & set(wide.columns))), [*PAGE, "path"], "left")
    raw = F.lit(None).cast("double")
    for op, (expr, _) in settled.items():
        raw = F.when((F.col("op") == op) & F.col("__there"), expr).otherwise(raw)
    parts = [rows.withColumn("raw", raw).select(*out)]
    if returned:
        back = X.restored(wide if whole is None else whole, content or {}, depth=depth, keys=PAGE)
        parts.append(asked.where(F.col("op").isin(*returned)).join(back, [*PAGE, "path"], "left").select(*out))
    if paged:
        keyed = wide.withColumn("deck", F.concat_ws("\u0001", "scenario", "deck"))
        mine = asked.where(F.col("op").isin(*paged)).withColumn("__deck", F.col("deck")).withColumn("deck", F.concat_ws("\u0001", "scenario", "deck"))
        for op in paged:
            of_op = mine.where(F.col("op") == op)
            got = X.zorder(of_op.select("deck", "slide", "path", "to"), keyed) if op == "zorder" else X.ungroup(keyed)
            parts.append(of_op.join(got, ["deck", "slide", "path"], "left").withColumn("deck", F.col("__deck")).select(*out))
    if children:
        got = child_raw(asked, facts, wide, children)
        mine = asked.where(F.col("op").isin(*children))
        parts.append((mine.withColumn("raw", F.lit(None).cast("double")) if got is None else mine.join(got, ["scenario", "deck", "id"], "left")).select(*out))
    return reduce(DataFrame.unionByName, parts)


def normalise_by_floor(raw: DataFrame, floor_scenario: str) -> DataFrame:
    """Add floor and score: credit above what the broken file already has."""
    mine = F.when(F.col("scenario") == floor_scenario, F.coalesce("raw", F.lit(0.0)))
    rows = raw.withColumn("floor", F.max(mine).over(Window.partitionBy("deck", "id"))).where(F.col("floor").isNotNull())
    have = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("raw", F.lit(0.0))))
    value = F.when(F.col("floor") >= 1.0, 0.0).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), (have - F.col("floor")) / (F.lit(1.0) - F.col("floor")))))
    return rows.withColumn("score", value)


# ------------------------------------------------------------------ gates: (scenario, deck) rows that fail

def gate_slide_order(gt_pages: DataFrame, pages: DataFrame, itself: DataFrame, damaged: DataFrame) -> DataFrame:
    """Wrong page count, or an undamaged page that holds another page's content."""
    want = gt_pages.groupBy("deck").agg(F.count(F.lit(1)).alias("n"))
    have = pages.groupBy("scenario", "deck").agg(F.count(F.lit(1)).alias("m"))
    count = have.join(want, "deck").where(F.col("n") != F.col("m")).select("scenario", "deck")
    moved = itself.where(~F.col("itself")).join(damaged.select("deck", "slide").distinct(), ["deck", "slide"], "left_anti").select("scenario", "deck")
    return count.unionByName(moved).distinct()


def unmatched(shapes: DataFrame, pairs: DataFrame) -> DataFrame:
    return shapes.join(pairs.select(*PAGE, F.col("other_path").alias("path")), [*PAGE, "path"], "left_anti")


def gate_overlay(loose: DataFrame, width: int, height: int) -> DataFrame:
    """A new visible picture or filled shape over most of the page."""
    big = F.col("w") * F.col("h") / (float(width) * height) >= OVERLAY_COVER
    drawn = F.col("blob").isNotNull() | F.col("fill_type").isNotNull()
    return loose.where(~F.coalesce("hidden", F.lit(False)) & big & drawn).select("scenario", "deck").distinct()


def gate_flattened(broken: DataFrame, shapes: DataFrame, scenarios: DataFrame) -> DataFrame:
    """A native object of the input is gone and a picture stands in its place."""
    box = ("cx", "cy", "w", "h")
    native = (broken.where(F.col("kind").isin(*NATIVE_KINDS)).select("deck", "slide", "kind", F.col("path").alias("obj"), *[F.col(c).alias(f"b_{c}") for c in box])
              .join(F.broadcast(scenarios), how="cross"))            # a handful of named scenarios
    there = shapes.where(F.col("kind").isin(*NATIVE_KINDS)).select(*PAGE, "kind", *[F.col(c).alias(f"a_{c}") for c in box])
    still = native.join(there, [*PAGE, "kind"]).where(same_place("a_", "b_")).select(*PAGE, "obj").distinct()
    gone = native.join(still, [*PAGE, "obj"], "left_anti")
    pics = shapes.where(F.col("blob").isNotNull()).select(*PAGE, *[F.col(c).alias(f"a_{c}") for c in box])
    return gone.join(pics, PAGE).where(covers("a_", "b_")).select("scenario", "deck").distinct()


def strong_key(shapes: DataFrame) -> DataFrame:
    first = F.try_element_at(F.filter("keys", is_strong), F.lit(1))
    return shapes.withColumn("strong_key", first).where(F.col("strong_key").isNotNull())


def gate_clones(gt: DataFrame, shapes: DataFrame, regions: DataFrame) -> DataFrame:
    """More copies of a strong identity than the answer has, one of them inside a damaged region."""
    box = ("cx", "cy", "w", "h")
    allowed = strong_key(gt).groupBy("deck", "slide", "strong_key").agg(F.count(F.lit(1)).alias("allowed"))
    keyed = strong_key(shapes)
    seen = keyed.groupBy(*PAGE, "strong_key").agg(F.count(F.lit(1)).alias("seen"))
    surplus = seen.join(allowed, ["deck", "slide", "strong_key"]).where(F.col("seen") > F.col("allowed"))
    extra = keyed.join(surplus, [*PAGE, "strong_key"]).select(*PAGE, *[F.col(c).alias(f"a_{c}") for c in box])
    where = regions.select("deck", "slide", *[F.col(c).alias(f"r_{c}") for c in box])
    return extra.join(where, ["deck", "slide"]).where(inside("a_", "r_")).select("scenario", "deck").distinct()


def media_of(shapes: DataFrame, keys: Sequence[str]) -> DataFrame:
    return shapes.where(F.col("blob").isNotNull()).select(*keys, F.col("blob").alias("sha")).distinct()


def gate_media(gt_media: DataFrame, input_media: DataFrame, media: DataFrame, supplied: DataFrame) -> DataFrame:
    """Answer-only media that nobody supplied has appeared."""
    secret = gt_media.join(input_media, ["deck", "sha"], "left_anti").join(supplied, ["deck", "sha"], "left_anti")
    return media.join(secret, ["deck", "sha"], "left_semi").select("scenario", "deck").distinct()


# ------------------------------------------------------------------ scope: (scenario, deck, n)

#: What the return of a whole shape is told from.
RESTORED_FACTS = ("kind", "grp", "plain", "blob", "cx", "cy", "w", "h", "fill_type", "fill_color", "line_fill", "line_color", "line_dash", "effects", "geom", "autofit")
STABLE_FACTS = ("kind", "plain", "blob", "cx", "cy", "w", "h", "fill_color", "line_color", "effects", "geom")


def scope_untouched_pages(wide: DataFrame, loose: DataFrame, damaged: DataFrame) -> DataFrame:
    """Undamaged pages on which any stable fact, addressed by pairing, differs."""
    changed = F.col("b_path").isNull()
    for f in STABLE_FACTS:
        changed = changed | ~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}"))
    touched = damaged.select("deck", "slide").distinct()
    pages = (wide.where(changed).select(*PAGE).unionByName(loose.select(*PAGE)).distinct()
             .join(touched, ["deck", "slide"], "left_anti"))
    return pages.groupBy("scenario", "deck").agg(F.count(F.lit(1)).alias("n"))


def scope_survivors(wide: DataFrame, regions: DataFrame) -> DataFrame:
    """Shapes of damaged pages that the damage left alone and that are gone; a dissolved group is not."""
    lost = wide.where(F.col("b_path").isNull()).select(*PAGE, F.col("a_path").alias("path"), F.col("a_grp").alias("grp"), F.col("a_kind").alias("kind"))
    pages = regions.select("deck", "slide").distinct()
    hit = regions.select("deck", "slide", "path").distinct()
    spared = (lost.join(pages, ["deck", "slide"], "left_semi").join(hit, ["deck", "slide", "path"], "left_anti")
              .join(hit.withColumnRenamed("path", "grp"), ["deck", "slide", "grp"], "left_anti"))
    gone_kids = lost.where(F.col("grp").isNotNull()).select(*PAGE, F.col("grp").alias("path")).distinct()
    groups = spared.where(F.col("kind") == "group").join(gone_kids, [*PAGE, "path"], "left_semi")
    rest = spared.where(F.col("kind") != "group")
    return groups.select(*PAGE).unionByName(rest.select(*PAGE)).groupBy("scenario", "deck").agg(F.count(F.lit(1)).alias("n"))


def scope_extra_shapes(loose: DataFrame, shapes: DataFrame, regions: DataFrame) -> DataFrame:
    """New top-level shapes of damaged pages outside every region; a group of matched shapes is free."""
    box = ("cx", "cy", "w", "h")
    pages = regions.select("deck", "slide").distinct()
    top = loose.where(F.col("grp").isNull()).join(pages, ["deck", "slide"], "left_semi")
    members = shapes.where(F.col("grp").isNotNull()).select(*PAGE, F.col("grp").alias("path")).distinct()
    surplus = loose.where(F.col("grp").isNotNull()).select(*PAGE, F.col("grp").alias("path")).distinct()
    tidy = (top.where(F.col("kind") == "group").join(members, [*PAGE, "path"], "left_semi")
            .join(surplus, [*PAGE, "path"], "left_anti").select(*PAGE, "path"))
    asked = top.join(tidy, [*PAGE, "path"], "left_anti").select(*PAGE, "path", *[F.col(c).alias(f"a_{c}") for c in box])
    where = regions.select("deck", "slide", *[F.col(c).alias(f"r_{c}") for c in box])
    fine = asked.join(where, ["deck", "slide"]).where(inside("a_", "r_")).select(*PAGE, "path").distinct()
    return asked.join(fine, [*PAGE, "path"], "left_anti").groupBy("scenario", "deck").agg(F.count(F.lit(1)).alias("n"))


def scope_media_lost(input_media: DataFrame, media: DataFrame, decks: DataFrame) -> DataFrame:
    """Fewer media parts than the input, by count."""
    before = input_media.groupBy("deck").agg(F.count(F.lit(1)).alias("before"))
    after = media.groupBy("scenario", "deck").agg(F.count(F.lit(1)).alias("after"))
    rows = decks.join(before, "deck").join(after, ["scenario", "deck"], "left").fillna(0, ["after"])
    return rows.where(F.col("after") < F.col("before")).select("scenario", "deck", F.lit(1).cast("long").alias("n"))


def penalties(scopes: dict[str, DataFrame]) -> DataFrame:
    """(scenario, deck, rule, n, cost): each violation at its rate up to its cap."""
    rows = None
    for rule, df in scopes.items():
        rate, cap = SCOPE_RATES[rule]
        part = df.select("scenario", "deck", F.lit(rule).alias("rule"), "n", F.least(F.lit(cap), F.col("n") * rate).alias("cost"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.where(F.col("n") > 0)


def final_scores(scores: DataFrame, failed: dict[str, DataFrame], costs: DataFrame) -> DataFrame:
    """(scenario, deck, total, penalty, failed_gate, score): zero on a failed gate, else less penalties."""
    total = scores.groupBy("scenario", "deck").agg(F.sum(F.col("weight") * F.col("score")).alias("total"))
    bad = None
    for i, gate in enumerate(GATES):
        if gate in failed:
            part = failed[gate].select("scenario", "deck", F.lit(i).alias("ord"), F.lit(gate).alias("gate"))
            bad = part if bad is None else bad.unionByName(part)
    first = bad.groupBy("scenario", "deck").agg(F.min_by("gate", "ord").alias("failed_gate"))
    cost = costs.groupBy("scenario", "deck").agg(F.least(F.lit(PENALTY_CAP), F.sum("cost")).alias("penalty"))
    rows = total.join(first, ["scenario", "deck"], "left").join(cost, ["scenario", "deck"], "left").fillna(0.0, ["penalty"])
    score = F.when(F.col("failed_gate").isNotNull(), 0.0).otherwise(F.bround(F.col("total") * (F.lit(1.0) - F.col("penalty")), 6))
    return rows.select("scenario", "deck", F.bround("total", 6).alias("total"), F.bround("penalty", 4).alias("penalty"), "failed_gate", score.alias("score"))


def calibration_findings(final: DataFrame, gt: str = "gt", broken: str = "noop") -> DataFrame:
    """Decks whose answer does not score 1 or whose broken file does not score 0."""
    want = F.when(F.col("scenario") == gt, 1.0).when(F.col("scenario") == broken, 0.0)
    return final.where(F.abs(F.col("score") - want) > 1e-6).select("deck", "scenario", "score")


def restore_fraction(gt: DataFrame, broken: DataFrame, components: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """Scenario frames in which the heaviest-first components up to each share of weight are restored.

    Components are taken in id order until the cumulative weight reaches the share.
    """
    order = Window.partitionBy("deck").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    upto = components.withColumn("upto", F.sum("weight").over(order))
    whole = upto.groupBy("deck", "slide", F.col("gt_path").alias("path")).agg(F.max("upto").alias("upto"))
    shares = F.explode(F.array(*[F.struct(F.concat(F.lit("restored_"), F.lit(str(int(f * 100)))).alias("scenario"), F.lit(f).alias("share")) for f in fractions]))
    keys = ["deck", "slide", "path"]
    fixed = gt.join(whole, keys).withColumn("s", shares).where(F.col("upto") <= F.col("s.share") + 1e-9).withColumn("scenario", F.col("s.scenario")).drop("s", "upto")
    rest = broken.withColumn("s", shares).withColumn("scenario", F.col("s.scenario")).drop("s")
    rest = rest.join(fixed.select("scenario", *keys), ["scenario", *keys], "left_anti")
    return fixed.select(*rest.columns).unionByName(rest)


# ------------------------------------------------------------------ one pass over scenarios

def graded_shapes(gt: DataFrame, components: DataFrame, depth: int) -> DataFrame:
    """(deck, slide, path, graded, returned): the shapes that components name, and what lies in them ``depth`` levels down.

    ``returned`` tells those that a component whose credit is the return of whole shapes reads.
    """
    keys, returned = ["deck", "slide", "path"], F.bool_or("returned").alias("returned")
    named = components.select("deck", "slide", F.col("gt_path").alias("path"), F.col("op").isin(*RETURN_OPS).alias("returned"))
    found = level = named.groupBy(*keys).agg(returned)
    members = gt.where(F.col("grp").isNotNull()).select(*keys, "grp")
    for _ in range(depth):
        level = members.join(level.withColumnRenamed("path", "grp"), ["deck", "slide", "grp"]).select(*keys, "returned")
        found = found.unionByName(level)
    return found.groupBy(*keys).agg(returned).withColumn("graded", F.lit(True))


class Scoring:
    """The tables one scoring pass shares, built lazily from gt, input and scenario frames."""

    def __init__(self, gt: DataFrame, broken: DataFrame, frames: DataFrame, components: DataFrame,
                 supplied: DataFrame, width: int, height: int, theme: DataFrame | None = None, ops: Sequence[str] = SCORED_OPS,
                 facts: Facts | None = None, unplaced: DataFrame | None = None):
        """``unplaced(scenario, deck, sha)`` are media parts that a candidate holds without showing them.

        All tables are read by many gates and rules, so what is costly to build is better written before (``put_down``).
        """
        self.gt, self.broken, self.frames = (M.with_keys(df) for df in (gt, broken, frames))
        self.components, self.supplied = components, supplied
        self.width, self.height, self.ops, self.facts, self.unplaced = width, height, ops, facts, unplaced
        spark = gt.sparkSession
        self.regions = damage_regions(components)
        names = [row[0] for row in frames.select("scenario").distinct().collect()]       # a handful
        self.scenarios = spark.createDataFrame([(n,) for n in names], "scenario string")
        read = {"path", "grp", "kind", "hidden", *STABLE_FACTS, *RESTORED_FACTS, *[c for _, needs in row_comparators(ops).values() for c in needs]}
        read |= {"z"} if set(ops) & set(PAGE_OPS) else set()
        empty = spark.createDataFrame([], "deck string, name string, value string")
        marked = X.themed(gt, theme if theme is not None else empty).join(graded_shapes(gt, components, X.MEMBER_DEPTH), ["deck", "slide", "path"], "left")
        marked = marked.withColumn("theme", F.when(F.col("graded"), F.col("theme")))
        # the side-by-side rows and the shapes that nothing took feed every comparator, gate and scope rule, so they are written once;
        # of shapes that no component names, rules read those that are lost or changed
        cols = [c for c in gt.columns if c in read and c in frames.columns]
        unless = None if set(ops) & set(PAGE_OPS) else ("graded", STABLE_FACTS)
        rows = put_down(M.wide_scenarios(marked, frames, names, cols, ["theme", "graded", "returned"], unless=unless))
        self.wide = rows.where(F.col("a_path").isNotNull())
        self.loose = rows.where(F.col("a_path").isNull()).select(*PAGE, *[F.col(f"b_{c}").alias(c) for c in cols])

    def raw(self) -> DataFrame:
        # what components are judged by; drawing order and groups are judged among all shapes of a page
        wide = self.wide if set(self.ops) & set(PAGE_OPS) else self.wide.where("graded")
        back = self.wide.where("returned")
        content = content_scores(self.facts, back) if self.facts else {}
        return component_raw(self.components, wide, content, self.ops, self.facts, X.MEMBER_DEPTH, self.scenarios, back)

    def media(self) -> DataFrame:
        shown = media_of(self.frames, ["scenario", "deck"])
        return shown if self.unplaced is None else shown.unionByName(self.unplaced.select("scenario", "deck", "sha")).distinct()

    def scores(self, floor_scenario: str = "noop") -> DataFrame:
        return normalise_by_floor(self.raw(), floor_scenario).join(self.components.select("deck", "id", "weight", "deg"), ["deck", "id"])

    def failed_gates(self, rejected: DataFrame | None = None) -> dict[str, DataFrame]:
        gt_pages = self.gt.select("deck", "slide").distinct()
        pages = self.frames.select(*PAGE).distinct()
        asked = gt_pages.join(F.broadcast(self.scenarios), how="cross")
        marks = M.page_signatures(self.frames, PAGE)
        itself = page_itself(asked, M.page_signatures(self.gt), marks)
        gt_media, in_media, media = media_of(self.gt, ["deck"]), media_of(self.broken, ["deck"]), self.media()
        out = {
            "slide_count_and_order": gate_slide_order(gt_pages, pages, itself, self.regions),
            "no_full_page_overlay": gate_overlay(self.loose, self.width, self.height),
            "native_objects_preserved": gate_flattened(self.broken, self.frames, self.scenarios),
            "no_cloned_shapes": gate_clones(self.gt, self.frames, self.regions),
            "media_not_pasted": gate_media(gt_media, in_media, media, self.supplied)}
        if rejected is not None:
            out["plan_accepted"] = rejected.select("deck").distinct().join(F.broadcast(self.scenarios), how="cross").select("scenario", "deck")
        return out

    def costs(self) -> DataFrame:
        decks = self.frames.select("scenario", "deck").distinct()
        return penalties({
            "untouched_pages_unchanged": scope_untouched_pages(self.wide, self.loose, self.regions),
            "survivors_intact": scope_survivors(self.wide, self.regions),
            "no_extra_shapes": scope_extra_shapes(self.loose, self.frames, self.regions),
            "input_media_preserved": scope_media_lost(media_of(self.broken, ["deck"]), self.media(), decks)})

    def final(self, rejected: DataFrame | None = None) -> DataFrame:
        return final_scores(self.scores(), self.failed_gates(rejected), self.costs())
