"""Adversarial scenarios and legitimate variants as shape frames, and how a battery is judged.

A scenario builder takes gt, input and the components and gives a shape frame; frames are tagged with
a ``scenario`` column, unioned and scored in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.ordered import first_per_key
from gradeloom.operators.compare import resolved
from gradeloom.operators.graph import components_of

PAGE = ["deck", "slide"]
KEY = ["deck", "slide", "path"]
# Fixed values.
VARIANT_SLACK = 0.02
STATUSES = ("scored", "n/a", "no_material", "unconstructible", "error", "not_run")


def tagged(frame: DataFrame, scenario: str) -> DataFrame:
    return frame.withColumn("scenario", F.lit(scenario))


def damaged_pages(components: DataFrame) -> DataFrame:
    return components.select(*PAGE).distinct()


def _row(base: DataFrame, like: DataFrame, **values: Column) -> DataFrame:
    """Rows with the columns of ``like``: given values, else null."""
    types = dict(like.dtypes)
    return base.select(*[(values[c] if c in values else F.col(c) if c in base.columns else F.lit(None)).cast(types[c]).alias(c)
                         for c in like.columns])


def screenshot_paste(broken: DataFrame, components: DataFrame, width: int, height: int) -> DataFrame:
    """One page-sized picture on top of every damaged page."""
    pages = damaged_pages(components)
    cover = _row(pages, broken, path=F.lit("cover"), kind=F.lit("picture"), z=F.lit(10**6), shape_id=F.lit(10**6), name=F.lit("cover"),
                 plain=F.lit(""), blob=F.lit("cover"), cx=F.lit(width // 2), cy=F.lit(height // 2), w=F.lit(width), h=F.lit(height),
                 rot=F.lit(0.0), hidden=F.lit(False), autofit=F.lit(False))
    return broken.unionByName(cover)


def clone_spam(broken: DataFrame, components: DataFrame) -> DataFrame:
    """Per deleted box, a copy of the largest surviving shape of the page placed at the hole."""
    best = first_per_key(broken.withColumn("__area", -F.col("w") * F.col("h")), PAGE, ["__area", "z", "path"],
                         [c for c in broken.columns if c not in PAGE])
    holes = components.where(F.col("op") == "delete").select(*PAGE, F.col("gt_path").alias("hole"), F.col("cx").alias("hx"), F.col("cy").alias("hy"))
    made = holes.join(best, PAGE)
    clone = _row(made, broken, path=F.concat(F.lit("clone-"), "hole"), name=F.concat(F.lit("copy "), "hole"), cx=F.col("hx"), cy=F.col("hy"),
                 grp=F.lit(None), shape_id=F.col("shape_id") + 10**6)
    return broken.unionByName(clone)


def native_to_picture(gt: DataFrame, broken: DataFrame, components: DataFrame, kinds: Sequence[str] = ("chart", "table", "smartart")) -> DataFrame:
    """Damaged composites become a picture at their place, whether the frame is still there or not."""
    hit = components.where(F.col("kind").isin(*kinds)).select(*PAGE, F.col("gt_path").alias("path")).distinct()
    left = broken.join(hit, KEY, "left_anti")
    box = gt.join(hit, KEY, "left_semi")
    pics = box.withColumn("kind", F.lit("picture")).withColumn("blob", F.lit("flat")).withColumn("plain", F.lit(""))
    return left.unionByName(pics.select(*left.columns))


def page_delete(broken: DataFrame, components: DataFrame) -> DataFrame:
    """Damaged pages removed and the rest numbered again."""
    left = broken.join(damaged_pages(components), PAGE, "left_anti")
    index = left.select(*PAGE).distinct().withColumn("__to", (F.row_number().over(Window.partitionBy("deck").orderBy("slide")) - 1).cast("long"))
    return left.join(index, PAGE).withColumn("slide", F.col("__to")).drop("__to")


def duplicate_gt_slide(gt: DataFrame, broken: DataFrame, components: DataFrame) -> DataFrame:
    """The answer's damaged pages appended after the broken deck's own pages."""
    last = broken.groupBy("deck").agg(F.max("slide").alias("__last"))
    pages = damaged_pages(components).withColumn("__n", F.row_number().over(Window.partitionBy("deck").orderBy("slide")))
    extra = gt.join(pages, PAGE).join(last, "deck").withColumn("slide", F.col("__last") + F.col("__n")).drop("__last", "__n")
    return broken.unionByName(extra.select(*broken.columns))


def rename_only(gt: DataFrame, broken: DataFrame, components: DataFrame) -> DataFrame:
    """The i-th shape of a damaged page takes the i-th wanted name, damaged names first."""
    hit = components.select(*PAGE, F.col("gt_path").alias("path")).distinct().withColumn("__hit", F.lit(True))
    page = Window.partitionBy(*PAGE)
    wanted = gt.join(damaged_pages(components), PAGE, "left_semi").join(hit, KEY, "left").select(
        *PAGE, F.col("name").alias("__name"), F.row_number().over(page.orderBy(F.col("__hit").isNull(), "z", "path")).alias("__i"))
    mine = broken.withColumn("__i", F.row_number().over(page.orderBy("z", "path")))
    return mine.join(wanted, [*PAGE, "__i"], "left").withColumn("name", F.coalesce("__name", "name")).drop("__name", "__i")


def orphan_media(gt_media: DataFrame, input_media: DataFrame) -> DataFrame:
    """(deck, sha) the answer has and the input lacks, to be added unplaced; no rows where there is none."""
    return gt_media.join(input_media, ["deck", "sha"], "left_anti")


def wrong_params(gt: DataFrame, components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The answer with every graded fact given a wrong value, and graded entries nobody touched."""
    ops = components.groupBy(*PAGE, F.col("gt_path").alias("path")).agg(F.collect_set("op").alias("__ops"))
    rows = gt.join(ops, KEY, "left")
    has = lambda op: F.coalesce(F.array_contains("__ops", op), F.lit(False))
    wrong = (rows.withColumn("cx", F.when(has("move") | has("delete"), F.col("cx") + 2000000).otherwise(F.col("cx")))
             .withColumn("plain", F.when(has("delete") & (F.col("plain") != ""), F.concat("plain", F.lit(" wrong"))).otherwise(F.col("plain")))
             .withColumn("blob", F.when(has("delete") & F.col("blob").isNotNull(), F.lit("wrongwrongwrong0")).otherwise(F.col("blob")))
             .withColumn("fill_color", F.when(has("recolor"), F.lit("srgb:010203")).otherwise(F.col("fill_color"))).drop("__ops"))
    untouched = components.where(~F.col("op").isin("move", "delete", "recolor")).select("deck", "id", "op")
    return wrong, untouched


def damage_untouched(base: DataFrame, components: DataFrame) -> DataFrame:
    """On one page outside the task, drop the later half of the top-level shapes and shift the others."""
    free = base.select(*PAGE).distinct().join(damaged_pages(components), PAGE, "left_anti")
    chosen = free.groupBy("deck").agg(F.min("slide").alias("slide")).withColumn("__chosen", F.lit(True))
    top = base.where(F.col("grp").isNull()).join(chosen, PAGE, "left_semi")
    page = Window.partitionBy(*PAGE)
    placed = top.select(*KEY, F.row_number().over(page.orderBy("z", "path")).alias("__i"), F.count(F.lit(1)).over(page).alias("__n"))
    rows = base.join(placed, KEY, "left")
    keep = rows.where(F.col("__i").isNull() | (F.col("__i") <= F.col("__n") - F.floor(F.col("__n") / 2)))
    shift = F.when(F.col("__i").isNotNull(), 914400).otherwise(0)
    return keep.withColumn("cx", F.col("cx") + shift).withColumn("cy", F.col("cy") + shift).drop("__i", "__n")


def merge_units(components: DataFrame) -> DataFrame:
    """(deck, deg, unit): degradations that share a page belong to one unit of work."""
    node = F.concat_ws("|", "deck", "deg")
    pages = components.select("deck", "slide", node.alias("node")).distinct()
    # each degradation of a page is tied to the page's smallest one, which is enough to connect them
    first = pages.groupBy("deck", "slide").agg(F.min("node").alias("a"))
    labels = components_of(pages.join(first, ["deck", "slide"]).select("a", F.col("node").alias("b")).distinct())
    parts = F.split("node", r"\|")
    return labels.select(F.element_at(parts, 1).alias("deck"), F.element_at(parts, 2).alias("deg"), F.element_at(F.split("label", r"\|"), 2).alias("unit"))


def half_restore(units: DataFrame) -> DataFrame:
    """(deck, units, mass): the units whose steps come nearest half of the deck's, fewest on ties, then the earliest.

    ``units(deck, unit, steps)`` with whole numbers of steps.  Neither nothing nor everything is a half:
    decks with fewer than two units of work have null.  Exact for any number of units: one array over
    the deck's step sums holds the fewest units for each, unit by unit.
    """
    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("unit")
        steps = frame["steps"].to_numpy(np.int64)
        total = int(steps.sum())
        fewest = np.full(total + 1, len(steps) + 1, np.int64)
        fewest[0] = 0
        taken = []
        for w in steps.tolist():
            better = np.zeros(total + 1, bool)
            if w:
                with_it = fewest[:total + 1 - w] + 1
                better[w:] = with_it < fewest[w:]
                fewest[w:] = np.minimum(fewest[w:], with_it)
            taken.append(np.packbits(better))

        def members(at: int) -> list[int]:
            chosen = []
            for i in range(len(steps) - 1, -1, -1):
                if taken[i][at // 8] >> (7 - at % 8) & 1:
                    chosen.append(i)
                    at -= int(steps[i])
            return chosen

        sums = np.flatnonzero(fewest <= len(steps))
        sums = sums[(sums > 0) & (sums < total)]
        if not len(sums):
            return pd.DataFrame({"deck": [frame["deck"].iloc[0]], "units": [None], "mass": [None]})
        apart = np.abs(2 * sums - total)
        sums = sums[apart == apart.min()]
        sums = sums[fewest[sums] == fewest[sums].min()]
        best = min((sorted(members(int(at)), reverse=True), int(at)) for at in sums)
        names = ",".join(frame["unit"].iloc[sorted(best[0])])
        return pd.DataFrame({"deck": [frame["deck"].iloc[0]], "units": [names], "mass": [best[1] / total]})

    return units.select("deck", "unit", F.col("steps").cast("long").alias("steps")).groupBy("deck").applyInPandas(choose, "deck string, units string, mass double")


# ------------------------------------------------------------------ legitimate variants

def _damaged_top(frame: DataFrame, components: DataFrame) -> DataFrame:
    hit = components.select(*PAGE, F.col("gt_path").alias("path")).distinct()
    return frame.where(F.col("grp").isNull()).join(hit, KEY, "left_semi")


def graded_paths(components: DataFrame, ops: Sequence[str]) -> DataFrame:
    """Paths a variant must leave alone because their operation is graded."""
    return components.where(F.col("op").isin(*ops)).select(*PAGE, F.col("gt_path").alias("path")).distinct()


def rebuilt_shapes(gt: DataFrame, components: DataFrame) -> DataFrame:
    """Damaged top-level shapes drawn again: new id, stock name, last in order."""
    made = _damaged_top(gt, components).join(graded_paths(components, ["zorder"]), KEY, "left_anti").select(*KEY, F.lit(True).alias("__new"))
    rows = gt.join(made, KEY, "left")
    new = F.col("__new").isNotNull()
    order = Window.partitionBy(*PAGE).orderBy(new, "z", "path")
    return (rows.withColumn("z", (F.row_number().over(order) - 1).cast("long"))
            .withColumn("shape_id", F.when(new, F.col("shape_id") + 10**6).otherwise(F.col("shape_id")))
            .withColumn("name", F.when(new, F.concat(F.initcap("kind"), F.lit(" 1"))).otherwise(F.col("name"))).drop("__new"))


def regrouped(gt: DataFrame, components: DataFrame) -> DataFrame:
    """Two or more damaged top-level shapes of a page wrapped in one group whose box is their union."""
    hit = _damaged_top(gt, components).where(F.col("kind") != "group")
    left, right = F.col("cx") - F.col("w") / 2, F.col("cx") + F.col("w") / 2
    top, low = F.col("cy") - F.col("h") / 2, F.col("cy") + F.col("h") / 2
    box = hit.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n"), F.min(left).alias("x0"), F.max(right).alias("x1"), F.min(top).alias("y0"), F.max(low).alias("y1")).where(F.col("n") >= 2)
    inside = hit.join(box.select(*PAGE), PAGE, "left_semi").select(*KEY, F.lit(True).alias("__in"))
    rows = gt.join(inside, KEY, "left").withColumn("grp", F.when(F.col("__in"), "g").otherwise(F.col("grp"))).withColumn(
        "path", F.when(F.col("__in"), F.concat(F.lit("g/"), "path")).otherwise(F.col("path"))).drop("__in")
    made = _row(box, rows, path=F.lit("g"), kind=F.lit("group"), z=F.lit(10**6), shape_id=F.lit(10**6), name=F.lit("Group 1"), plain=F.lit(""),
                cx=F.floor((F.col("x0") + F.col("x1")) / 2), cy=F.floor((F.col("y0") + F.col("y1")) / 2), w=F.floor(F.col("x1") - F.col("x0")),
                h=F.floor(F.col("y1") - F.col("y0")), rot=F.lit(0.0), hidden=F.lit(False), autofit=F.lit(False))
    return rows.unionByName(made)


def ungrouped(gt: DataFrame, components: DataFrame) -> DataFrame:
    """Groups that hold damage dissolved, members keep their page places; turned or graded groups stay."""
    hit = components.select(*PAGE, F.col("gt_path").alias("path")).distinct()
    holding = gt.where(F.col("grp").isNotNull()).join(hit, KEY, "left_semi").select(*PAGE, F.col("grp").alias("path")).distinct()
    open_groups = (gt.where((F.col("kind") == "group") & (F.col("rot") == 0)).join(holding, KEY, "left_semi")
                   .join(graded_paths(components, ["ungroup"]), KEY, "left_anti").select(*KEY))
    rest = gt.join(open_groups, KEY, "left_anti")
    freed = open_groups.select(*PAGE, F.col("path").alias("grp"), F.lit(True).alias("__free"))
    return rest.join(freed, [*PAGE, "grp"], "left").withColumn("grp", F.when(F.col("__free").isNull(), F.col("grp"))).drop("__free").select(*gt.columns)


def text_retyped(runs: DataFrame, hit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every run of four or more characters of ``hit`` split in half with the same properties."""
    rows = runs.join(hit.select(*keys).distinct().withColumn("__hit", F.lit(True)), list(keys), "left")
    half = F.floor(F.length("t") / 2).cast("int")
    parts = F.when(F.col("__hit") & (F.length("t") >= 4), F.array(F.struct(F.lit(0).alias("part"), F.substring("t", F.lit(1), half).alias("t")),
                   F.struct(F.lit(1).alias("part"), F.substring("t", half + 1, F.length("t")).alias("t")))).otherwise(
                   F.array(F.struct(F.lit(0).alias("part"), F.col("t").alias("t"))))
    return rows.withColumn("__p", F.explode(parts)).withColumn("t", F.col("__p.t")).withColumn("part", F.col("__p.part")).drop("__p", "__hit")


def picture_reinserted(gt: DataFrame, components: DataFrame) -> DataFrame:
    """Damaged pictures inserted again: same bytes and place, new id and name, last among siblings."""
    hit = components.select(*PAGE, F.col("gt_path").alias("path")).distinct()
    pics = gt.where(F.col("blob").isNotNull()).join(hit, KEY, "left_semi").select(*KEY, F.lit(True).alias("__new"))
    rows = gt.join(pics, KEY, "left")
    new = F.col("__new").isNotNull()
    family = Window.partitionBy(*PAGE, F.coalesce("grp", F.lit("")))
    return (rows.withColumn("__last", F.max("z").over(family)).withColumn("z", F.when(new, F.col("__last") + 1 + F.col("z")).otherwise(F.col("z")))
            .withColumn("shape_id", F.when(new, F.col("shape_id") + 10**6).otherwise(F.col("shape_id")))
            .withColumn("name", F.when(new, F.lit("Picture 1")).otherwise(F.col("name"))).drop("__new", "__last"))


def colour_written_out(gt: DataFrame, components: DataFrame, theme: DataFrame) -> DataFrame:
    """Plain theme colours of damaged shapes replaced by the colour the theme gives them."""
    hit = components.select(*PAGE, F.col("gt_path").alias("path")).distinct().withColumn("__hit", F.lit(True))
    maps = theme.groupBy("deck").agg(F.map_from_entries(F.collect_list(F.struct(F.col("name"), F.col("value")))).alias("theme"))
    rows = gt.join(hit, KEY, "left").join(maps, "deck", "left")
    for c in ("fill_color", "line_color"):
        rows = rows.withColumn(c, F.when(F.col("__hit"), resolved(F.col(c))).otherwise(F.col(c)))
    return rows.drop("__hit", "theme")


# ------------------------------------------------------------------ judging a battery

# What each attack may score at most, must score, or must cost against another one.
EXPECTED = (
    # attack, kind, lo, hi, tol, ref, gap
    ("noop", "nothing_already_right", 0.0, 0.0, 0.0, None, 0.0),
    ("gt", "exact", 1.0, 0.0, 1e-9, None, 0.0),
    ("gt_roundtrip", "at_most", 0.0, 1.0, 0.0, None, 0.0),
    ("screenshot_paste", "at_most", 0.0, 0.05, 0.0, None, 0.0),
    ("clone_spam", "at_most", 0.0, 0.05, 0.0, None, 0.0),
    ("native_to_picture", "at_most", 0.0, 0.05, 0.0, None, 0.0),
    ("page_delete", "at_most", 0.0, 0.05, 0.0, None, 0.0),
    ("rename_only", "at_most", 0.0, 0.05, 0.0, None, 0.0),
    ("orphan_media", "at_most", 0.0, 0.05, 0.0, None, 0.0),
    ("duplicate_gt_slide", "at_most", 0.0, 0.05, 0.0, None, 0.0),
    ("wrong_params", "at_most", 0.0, 0.30, 0.0, None, 0.0),
    ("damage_untouched", "no_gain", 0.0, 0.0, 0.0, "noop", 0.0),
    ("damage_untouched_gt", "costs", 0.0, 0.0, 0.0, "gt", 0.05),
    ("half_restore", "between", 0.35, 0.65, 0.0, None, 0.0),
)
EXPECTED_SCHEMA = "attack string, expect_kind string, lo double, hi double, tol double, ref string, gap double"


def attack_frames(gt: DataFrame, broken: DataFrame, components: DataFrame, halves: DataFrame, width: int, height: int) -> dict[str, DataFrame]:
    """A frame of every attack that is built from shapes; ``halves(deck, slide, path)`` are put right in ``half_restore``."""
    return {
        "noop": broken, "gt": gt, "orphan_media": broken,
        "screenshot_paste": screenshot_paste(broken, components, width, height), "clone_spam": clone_spam(broken, components),
        "native_to_picture": native_to_picture(gt, broken, components), "page_delete": page_delete(broken, components),
        "rename_only": rename_only(gt, broken, components), "duplicate_gt_slide": duplicate_gt_slide(gt, broken, components),
        "wrong_params": wrong_params(gt, components)[0], "damage_untouched": damage_untouched(broken, components),
        "damage_untouched_gt": damage_untouched(gt, components),
        "half_restore": broken.join(halves, KEY, "left_anti").unionByName(gt.join(halves, KEY, "left_semi").select(*broken.columns))}


def variant_frames(gt: DataFrame, components: DataFrame, theme: DataFrame) -> dict[str, DataFrame]:
    """Legitimate answers whose shapes keep their paths."""
    return {"variant_rebuilt": rebuilt_shapes(gt, components), "variant_ungrouped": ungrouped(gt, components),
            "variant_picture": picture_reinserted(gt, components), "variant_colour": colour_written_out(gt, components, theme)}


def attack_status(gt: DataFrame, components: DataFrame, withheld: DataFrame, halves: DataFrame, expected: DataFrame,
                  kinds: Sequence[str] = ("chart", "table", "smartart")) -> DataFrame:
    """(deck, attack, status): n/a where the damage gives an attack nothing to do, no_material where the deck has nothing
    to build it from, not_run for the round trip through an application, else scored."""
    spare = gt.select(*PAGE).distinct().join(damaged_pages(components), PAGE, "left_anti").select("deck", F.lit(True).alias("spare")).distinct()
    has = components.groupBy("deck").agg(F.bool_or(F.col("op") == "delete").alias("holes"), F.bool_or(F.col("kind").isin(*kinds)).alias("native"))
    for rows, name in ((withheld, "withheld"), (halves, "halves")):
        has = has.join(rows.select("deck", F.lit(True).alias(name)).distinct(), "deck", "left")
    has = has.join(spare, "deck", "left").fillna(False, ["spare", "withheld", "halves", "native", "holes"])
    of = F.col("attack")
    status = (F.when(of == "gt_roundtrip", "not_run").when((of == "clone_spam") & ~F.col("holes"), "n/a").when((of == "native_to_picture") & ~F.col("native"), "n/a")
              .when((of == "orphan_media") & ~F.col("withheld"), "n/a").when(of.startswith("damage_untouched") & ~F.col("spare"), "no_material")
              .when((of == "half_restore") & ~F.col("halves"), "no_material").otherwise("scored"))
    return has.join(F.broadcast(expected.select("attack")), how="cross").select("deck", "attack", status.alias("status"))     # a handful of named attacks


def battery_rows(status: DataFrame, final: DataFrame, scores: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per deck and attack: status, score, first failed gate, credit before the floor, and what was expected."""
    already = scores.groupBy("scenario", "deck").agg(F.sum(F.col("weight") * F.greatest(F.lit(0.0), F.coalesce("raw", F.lit(0.0)))).alias("already"))
    got = final.join(already, ["scenario", "deck"], "left").select(F.col("scenario").alias("attack"), "deck", F.col("score").alias("__score"), "failed_gate", "already")
    rows = status.join(got, ["deck", "attack"], "left").join(F.broadcast(expected), "attack")
    there = F.col("status") == "scored"
    rows = rows.withColumn("status", F.when(there & F.col("__score").isNull(), "error").otherwise(F.col("status")))
    return rows.withColumn("score", F.when(there, F.col("__score"))).withColumn("note", F.coalesce("failed_gate", F.lit(""))).drop("__score")

def check_expectations(rows: DataFrame) -> DataFrame:
    """Add ``ok``; rows carry deck, attack, status, score, expect_kind, lo, hi, tol, ref, gap, already."""
    base = rows.where(F.col("status") == "scored").select("deck", F.col("attack").alias("ref"), F.col("score").alias("__base"))
    j = rows.join(base, ["deck", "ref"], "left")
    s = F.col("score")
    ok = (F.when(F.col("expect_kind") == "exact", F.abs(s - F.col("lo")) <= F.col("tol"))
          .when(F.col("expect_kind") == "at_most", s <= F.col("hi") + 1e-9)
          .when(F.col("expect_kind") == "between", s.between(F.col("lo") - 1e-9, F.col("hi") + 1e-9))
          .when(F.col("expect_kind") == "no_gain", s <= F.col("__base") + 1e-6)
          .when(F.col("expect_kind") == "costs", (F.col("__base") >= F.col("gap")) & (s <= F.col("__base") - F.col("gap") + 1e-6))
          .when(F.col("expect_kind") == "nothing_already_right", (F.abs(s) <= 1e-9) & (F.col("already") <= F.col("hi") + 1e-9)))
    return j.withColumn("ok", F.when(F.col("status") == "scored", F.coalesce(ok, F.lit(False)))).drop("__base")


def check_variants(final: DataFrame, scores: DataFrame, reference: str = "gt", worst: int = 2) -> tuple[DataFrame, DataFrame]:
    """(verdicts, worst losers): no gate and at most 0.02 below the reference; largest weight times loss."""
    base = final.where(F.col("scenario") == reference).select("deck", F.col("score").alias("base"))
    verdicts = final.where(F.col("scenario") != reference).join(base, "deck").select(
        "scenario", "deck", "score", (F.col("failed_gate").isNull() & (F.col("score") >= F.col("base") - VARIANT_SLACK)).alias("ok"))
    loss = F.col("weight") * (F.lit(1.0) - F.col("score"))
    place = F.row_number().over(Window.partitionBy("scenario", "deck").orderBy(loss.desc(), "id"))
    losers = scores.withColumn("loss", loss).where(F.col("loss") > 0).withColumn("place", place).where(F.col("place") <= worst)
    return verdicts, losers.select("scenario", "deck", "id", "loss", "place")


def top_paid(scores: DataFrame, k: int = 2) -> DataFrame:
    """The components that paid most in each scenario, whatever the plan gate says."""
    paid = scores.withColumn("paid", F.col("weight") * F.col("score")).where(F.col("paid") > 0)
    place = F.row_number().over(Window.partitionBy("scenario", "deck").orderBy(F.desc("paid"), "id"))
    return paid.withColumn("place", place).where(F.col("place") <= k).select("scenario", "deck", "id", "paid", "place")


def coverage(rows: DataFrame) -> DataFrame:
    return rows.groupBy("deck").agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if(F.col("status") == s).alias(s.replace("/", "")) for s in STATUSES])


def reasons_and_warnings(rows: DataFrame) -> DataFrame:
    """(deck, attack, level, note): vetoes and warnings; the monotonicity probe only warns."""
    failed = (F.col("status") == "scored") & (F.col("ok") == F.lit(False))
    probe = F.col("attack") == "half_restore"
    level = (F.when(failed & ~probe, "reason").when(failed & probe, "warning")
             .when(F.col("status").isin("unconstructible", "not_run", "error"), "warning"))
    scored = rows.groupBy("deck").agg(F.bool_or(F.col("status") == "scored").alias("__s"), F.bool_or(F.col("status") == "no_material").alias("__n"))
    nothing = scored.where(~F.col("__s") & F.col("__n")).select("deck", F.lit("*").alias("attack"), F.lit("reason").alias("level"), F.lit("nothing could be scored").alias("note"))
    return rows.withColumn("level", level).where(F.col("level").isNotNull()).select("deck", "attack", "level", "note").unionByName(nothing)


def cross_deck_summary(notes: DataFrame, decks: DataFrame) -> DataFrame:
    """(attack, decks): how many decks each attack rejects, and the survivors as ``survivors``."""
    bad = notes.where(F.col("level") == "reason")
    per = bad.groupBy("attack").agg(F.countDistinct("deck").alias("decks"))
    alive = decks.join(bad.select("deck").distinct(), "deck", "left_anti").agg(F.count(F.lit(1)).alias("decks")).select(F.lit("survivors").alias("attack"), "decks")
    return per.unionByName(alive)


def differing_parts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per deck, how many parts differ between two packages, absent ones included."""
    x, y = a.withColumnRenamed("sha", "was"), b.withColumnRenamed("sha", "now")
    return x.join(y, ["deck", "part"], "full").groupBy("deck").agg(F.count_if(~F.col("was").eqNullSafe(F.col("now"))).alias("differing"))


def roundtrip_problems(facts: DataFrame) -> DataFrame:
    """(deck, problem) of a recorded round trip: sizes, digests and at least one differing part."""
    rules = F.array(
        F.when(F.coalesce("saved_bytes", F.lit(0)) <= 0, "saved file is empty"),
        F.when(~F.coalesce("source_sha", F.lit("")).rlike("^[0-9a-f]{64}$"), "source digest malformed"),
        F.when(F.col("source_sha") != F.col("actual_sha"), "recorded for another source"),
        F.when(F.col("saved_sha") == F.col("source_sha"), "nothing was saved"),
        F.when(F.coalesce("differing", F.lit(0)) == 0, "no part differs"))
    return facts.select("deck", F.explode(F.array_compact(rules)).alias("problem"))


def hardening_caveats(rows: DataFrame) -> DataFrame:
    """(deck, caveat, attack): gaps a hardening record must state."""
    gap = (F.when(F.col("status") == "no_material", "no material").when(F.col("status") == "not_run", "not run")
           .when((F.col("status") == "scored") & F.col("weak_barrier"), "weak barrier"))
    return rows.withColumn("caveat", gap).where(gap.isNotNull()).select("deck", "caveat", "attack")
