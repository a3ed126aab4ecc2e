"""Recorded damage: controlled changes of a keyed table, with a change log.

Every operation takes the shapes and its steps ``(deck, slide, path, deg, ...)`` and gives
``(damaged, delta)``.  Paths are those of the snapshot before any step.  A step that changes nothing
leaves no delta row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.geometry import EMU

KEY = ["deck", "slide", "path"]
Now = Callable[[str], Column]  # a column's value so far
Step = Callable[[str], Column]  # a parameter of the step
DELTA = ["deck", "slide", "path", "op", "deg", "fact", "was", "now"]


LOG_ROW = "array<struct<op:string,deg:string,fact:string,was:string,now:string>>"


def _change(shapes: DataFrame, steps: DataFrame, edits: dict[str, dict[str, Callable[[Now, Step], Column]]]) -> tuple[DataFrame, DataFrame]:
    """Fold each shape's steps in their order (``step_no``, then ``deg``) and log every value that really changed.

    ``edits`` gives, by operation, a column's new value from the values so far and the step.  Steps carry
    ``op`` where there are several.  A shape stays one row however many steps it has.
    """
    only = next(iter(edits)) if len(edits) == 1 else None
    extra = [c for c in steps.columns if c not in KEY]
    order = [c for c in ("step_no", "deg") if c in extra]
    row = F.struct(*order, *[c for c in extra if c not in order])
    asked = steps.groupBy(*KEY).agg(F.array_sort(F.collect_list(row)).alias("__steps"))
    columns = list(dict.fromkeys(c for own in edits.values() for c in own))
    kinds = dict(shapes.dtypes)
    state = F.struct(*[F.col(c).alias(c) for c in columns], F.array().cast(LOG_ROW).alias("log"))

    def fold(now: Column, step: Column) -> Column:
        def value(c: str) -> Column:
            return now[c] if c in columns else F.col(c)

        made, noted = {}, []
        for c in columns:
            new = now[c]
            for op, own in edits.items():
                if c in own:
                    changed = own[c](value, step.getField).cast(kinds[c])
                    new = changed if only else F.when(step["op"] == op, changed).otherwise(new)
            made[c] = new
            op = F.lit(only) if only else step["op"]
            noted.append(F.struct(op.alias("op"), step["deg"].alias("deg"), F.lit(c).alias("fact"), now[c].cast("string").alias("was"), new.cast("string").alias("now")))
        log = F.filter(F.array(*noted), lambda x: ~x["was"].eqNullSafe(x["now"]))
        return F.struct(*[made[c].alias(c) for c in columns], F.concat(now["log"], log).alias("log"))

    joined = shapes.join(asked, KEY, "left").withColumn("__done", F.when(F.col("__steps").isNotNull(), F.aggregate("__steps", state, fold)))
    out = joined.withColumns({c: F.when(F.col("__done").isNotNull(), F.col("__done")[c]).otherwise(F.col(c)) for c in columns}).select(*shapes.columns)
    log = joined.where(F.col("__done").isNotNull()).select(*KEY, F.explode(F.col("__done")["log"]).alias("x")).select(*KEY, "x.op", "x.deg", "x.fact", "x.was", "x.now")
    return out, log


def delete(shapes: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove rows by path; what sits inside a removed container goes with it, at any depth."""
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    roots = F.array_distinct(F.array_compact(F.concat(above, F.array("grp"))))
    lines = shapes.select(*KEY, "kind", F.explode(roots).alias("__root"))
    gone = lines.join(steps.select("deck", "slide", F.col("path").alias("__root"), "deg"), ["deck", "slide", "__root"])
    left = shapes.join(gone.select(*KEY).distinct(), KEY, "left_anti")
    log = gone.groupBy(*KEY).agg(F.min("deg").alias("deg"), F.first("kind").alias("was")).select(
        *KEY, F.lit("delete").alias("op"), "deg", F.lit("shape").alias("fact"), "was", F.lit(None).cast("string").alias("now"))
    return left, log


def scatter(shapes: DataFrame, steps: DataFrame, amplitude_in: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Bounded offsets from a keyed hash, the same on every run: x within the amplitude, y within 0.55 of it."""
    def uniform(tag: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(tag), *KEY), F.lit(2000001)) / 1000000.0 - 1.0

    span = amplitude_in * EMU
    return _change(shapes, steps, {"scatter": {"cx": lambda now, step: now("cx") + (uniform("x") * span).cast("long"),
                                               "cy": lambda now, step: now("cy") + (uniform("y") * span * 0.55).cast("long")}})


def _grown(now: Now, step: Step, side: str) -> Column:
    return (now(side) * step("factor")).cast("long")


def _corner_kept(axis: str, side: str) -> Callable[[Now, Step], Column]:
    return lambda now, step: F.when(step("keep_centre"), now(axis)).otherwise(now(axis) + F.floor((_grown(now, step, side) - now(side)) / 2))


def _turned(now: Now, step: Step) -> Column:
    return F.coalesce(F.pmod(now("rot") + step("angle").try_cast("double"), F.lit(360.0)), now("rot"))


#: New values by operation; each step's parameters are columns of the steps.
EDITS: dict[str, dict[str, Callable[[Now, Step], Column]]] = {
    # dx_in and dy_in in inches
    "move": {"cx": lambda now, step: now("cx") + (step("dx_in") * EMU).cast("long"), "cy": lambda now, step: now("cy") + (step("dy_in") * EMU).cast("long")},
    # scale by factor with whole-number truncation; without keep_centre the top left corner stays
    "resize": {"cx": _corner_kept("cx", "w"), "cy": _corner_kept("cy", "h"),
               "w": lambda now, step: _grown(now, step, "w"), "h": lambda now, step: _grown(now, step, "h")},
    "swap": {"cx": lambda now, step: step("to_cx"), "cy": lambda now, step: step("to_cy")},
    # empty the text, or keep its first paragraph where keep_first says so
    "clear_text": {"plain": lambda now, step: F.when(step("keep_first"), F.substring_index(now("plain"), "\n", 1)).otherwise("")},
    "set_text": {"plain": lambda now, step: step("text")},
    "set_font": {"font": lambda now, step: F.coalesce(step("new_font"), now("font")), "sz": lambda now, step: F.coalesce(step("new_sz"), now("sz")),
                 "bold": lambda now, step: F.coalesce(step("new_bold"), now("bold"))},
    # drop effects and flatten gradients; shapes without either leave no trace
    "strip_effects": {"effects": lambda now, step: F.lit(None), "fill_type": lambda now, step: F.when(now("fill_type") == "gradient", "solid").otherwise(now("fill_type"))},
    "recolor": {"fill_type": lambda now, step: F.lit("solid"), "fill_color": lambda now, step: step("color")},
    "outline": {"line_fill": lambda now, step: F.lit("solid"), "line_color": lambda now, step: step("color"), "line_w": lambda now, step: step("width")},
    "rotate": {"rot": _turned},
    "crop": {"crop": lambda now, step: step("new_crop")},
}


def edit(shapes: DataFrame, steps: DataFrame, op: str) -> tuple[DataFrame, DataFrame]:
    """One operation of ``EDITS``."""
    return _change(shapes, steps, {op: EDITS[op]})


def apply_recipe(shapes: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``steps`` of several operations (``op``) in one fold; parameters of other operations may be null or absent."""
    fits = {op: own for op, own in EDITS.items() if op in RECIPE_PARAMETERS and set(RECIPE_PARAMETERS[op]) <= set(steps.columns)
            and set(own) <= set(shapes.columns)}
    return _change(shapes, steps, fits)


RECIPE_PARAMETERS = {"move": ("dx_in", "dy_in"), "resize": ("factor", "keep_centre"), "clear_text": ("keep_first",), "set_text": ("text",),
                     "set_font": ("new_font", "new_sz", "new_bold"), "strip_effects": (), "recolor": ("color",), "outline": ("color", "width"), "rotate": ("angle",)}


def swap(shapes: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exchange the places of ``pairs(deck, slide, path, other, deg)``, one log row per end and axis."""
    ends = pairs.select("deck", "slide", "path", "other", "deg").unionByName(
        pairs.select("deck", "slide", F.col("other").alias("path"), F.col("path").alias("other"), "deg"))
    there = shapes.select("deck", "slide", F.col("path").alias("other"), F.col("cx").alias("to_cx"), F.col("cy").alias("to_cy"))
    return edit(shapes, ends.join(there, ["deck", "slide", "other"]), "swap")


def drop_value(shapes: DataFrame, steps: DataFrame, op: str, column: str) -> tuple[DataFrame, DataFrame]:
    """Null one part out: an equation, a transition, a crop."""
    return _change(shapes, steps, {op: {column: lambda now, step: F.lit(None)}})


def zorder(shapes: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Send to back or bring to front among the siblings; later steps go further, no-ops aren't logged.

    A shape stays within its parent: the parent's places in the drawing order are dealt anew.
    """
    number = [c for c in ("step_no",) if c in steps.columns]
    last = steps.withColumn("__seq", F.row_number().over(Window.partitionBy("deck", "slide").orderBy(*number, "deg", "path")))
    last = last.groupBy(*KEY).agg(F.max_by(F.struct("to", "deg", "__seq"), "__seq").alias("__s")).select(*KEY, "__s.*")
    family = [F.col("deck"), F.col("slide"), F.col("grp")]
    back, front = F.col("to") == "back", F.col("to") == "front"
    joined = shapes.join(last, KEY, "left")
    order = Window.partitionBy(*family).orderBy(F.when(back, -1).when(front, 1).otherwise(0), F.when(back, -F.col("__seq")).when(front, F.col("__seq")), "z", "path")
    placed = (joined.withColumn("__now", (F.row_number().over(order) - 1).cast("long"))
              .withColumn("__was", (F.row_number().over(Window.partitionBy(*family).orderBy("z", "path")) - 1).cast("long")))
    log = placed.where(F.col("to").isNotNull() & (F.col("__was") != F.col("__now"))).select(
        *KEY, F.lit("zorder").alias("op"), "deg", F.lit("z").alias("fact"), F.col("__was").cast("string").alias("was"), F.col("__now").cast("string").alias("now"))
    slots = placed.select(F.col("deck").alias("__d"), F.col("slide").alias("__p"), F.col("grp").alias("__g"), F.col("__was").alias("__k"), F.col("z").alias("__z"))
    out = placed.join(slots, (F.col("deck") == F.col("__d")) & (F.col("slide") == F.col("__p")) & F.col("grp").eqNullSafe(F.col("__g")) & (F.col("__now") == F.col("__k")))
    return out.withColumn("z", F.col("__z")).select(*shapes.columns), log


def ungroup(shapes: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove group rows and free their members, which keep their page coordinates."""
    groups = steps.select("deck", "slide", F.col("path").alias("grp"), "deg")
    kids = shapes.join(groups, ["deck", "slide", "grp"])
    log = kids.select(*KEY, F.lit("ungroup").alias("op"), "deg", F.lit("grp").alias("fact"), F.col("grp").alias("was"), F.lit(None).cast("string").alias("now"))
    rest = shapes.join(steps.select(*KEY), KEY, "left_anti").join(groups.select("deck", "slide", "grp"), ["deck", "slide", "grp"], "left_anti")
    freed = kids.withColumn("grp", F.lit(None).cast("string")).drop("deg")
    return rest.unionByName(freed.select(*rest.columns)), log


def clear_cells(cells: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Empty cells of the named rows and columns (null means every one); empty cells are not logged."""
    hit = cells.join(steps, KEY).where((F.col("r").eqNullSafe(F.col("row")) | F.col("row").isNull())
                                       & (F.col("c").eqNullSafe(F.col("col")) | F.col("col").isNull()) & (F.col("text") != ""))
    log = hit.groupBy(*KEY, "r", "c").agg(F.min("deg").alias("deg"), F.first("text").alias("was"))
    marked = cells.join(log.select(*KEY, "r", "c", F.lit(True).alias("__x")), [*KEY, "r", "c"], "left")
    return marked.withColumn("text", F.when(F.col("__x"), "").otherwise(F.col("text"))).drop("__x"), log


def drop_lines(cells: DataFrame, steps: DataFrame, axis: str) -> tuple[DataFrame, DataFrame]:
    """Drop rows or columns ``steps(KEY, no, deg)`` and close the gaps."""
    log = cells.join(steps.withColumnRenamed("no", axis), [*KEY, axis]).groupBy(*KEY, axis).agg(
        F.min("deg").alias("deg"), F.concat_ws("|", F.transform(F.sort_array(F.collect_list(F.struct("r", "c", "text"))), lambda x: x["text"])).alias("was"))
    left = cells.join(steps.select(*KEY, F.col("no").alias(axis)).distinct(), [*KEY, axis], "left_anti")
    place = F.dense_rank().over(Window.partitionBy(*KEY).orderBy(axis)) - 1
    return left.withColumn(axis, place.cast("long")), log


def text_runs(runs: DataFrame, steps: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Paragraphs by number or by a phrase: deleted, or emptied where the body would have none, or restyled.

    ``steps(keys, para, phrase, action, new_font)``.
    """
    paras = runs.groupBy(*keys, "para").agg(F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("run", "t"))), lambda x: x["t"])).alias("text"))
    count = paras.groupBy(*keys).agg(F.count(F.lit(1)).alias("__paras"))
    asked = steps.withColumnRenamed("para", "__para")
    hit = paras.join(asked, keys).join(count, keys).where(
        (F.col("para") == F.col("__para")) | (F.col("__para").isNull() & F.contains("text", F.col("phrase"))))
    action = F.when((F.col("action") == "deleted") & (F.col("__paras") == 1), "emptied").otherwise(F.col("action"))
    log = hit.groupBy(*keys, "para").agg(F.min(action).alias("action"), F.first("text").alias("was"), F.min("new_font").alias("new_font"))
    marked = runs.join(log.select(*keys, "para", "action", "new_font"), [*keys, "para"], "left")
    kept = marked.where(~F.coalesce(F.col("action") == "deleted", F.lit(False)))
    kept = kept.withColumn("t", F.when(F.col("action") == "emptied", "").otherwise(F.col("t"))).withColumn(
        "font", F.when(F.col("action") == "restyled", F.col("new_font")).otherwise(F.col("font")))
    return kept.drop("action", "new_font"), log


def detach(shapes: DataFrame, steps: DataFrame, nudge_in: float = 0.4) -> tuple[DataFrame, DataFrame]:
    none = F.lit(None).cast("long")
    return _change(shapes, steps, {"detach_connector": {"start_id": lambda now, step: none, "end_id": lambda now, step: none,
                                                        "cx": lambda now, step: now("cx") + int(nudge_in * EMU)}})


def drop_steps(effects: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop build steps ``steps(deck, slide, step_no)`` counted from 1, or all with a null, and renumber."""
    ask = steps.withColumn("step", F.col("step_no") - 1)
    every = steps.where(F.col("step_no").isNull()).select("deck", "slide").distinct()
    gone = effects.join(ask.select("deck", "slide", "step").distinct(), ["deck", "slide", "step"], "left_semi").unionByName(
        effects.join(every, ["deck", "slide"], "left_semi")).distinct()
    log = gone.groupBy("deck", "slide", "step").agg(F.count(F.lit(1)).alias("effects"))
    left = effects.join(log.select("deck", "slide", "step"), ["deck", "slide", "step"], "left_anti")
    place = F.dense_rank().over(Window.partitionBy("deck", "slide").orderBy("step")) - 1
    return left.withColumn("step", place.cast("long")), log


def blank_slides(shapes: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete every top-level shape of a page, and with containers what is inside them."""
    steps = shapes.where(F.col("grp").isNull()).join(pages, ["deck", "slide"]).select(*KEY, "deg")
    return delete(shapes, steps)


def delete_slides(shapes: DataFrame, pages: DataFrame) -> DataFrame:
    """Remove pages and renumber the rest of the deck."""
    left = shapes.join(pages.select("deck", "slide"), ["deck", "slide"], "left_anti")
    index = left.select("deck", "slide").distinct().withColumn(
        "__to", (F.row_number().over(Window.partitionBy("deck").orderBy("slide")) - 1).cast("long"))
    return left.join(index, ["deck", "slide"]).withColumn("slide", F.col("__to")).drop("__to")


def swap_slides(shapes: DataFrame, swaps: DataFrame) -> DataFrame:
    """Exchange pages ``swaps(deck, a, b)``."""
    ends = swaps.select("deck", F.col("a").alias("slide"), F.col("b").alias("__to")).unionByName(
        swaps.select("deck", F.col("b").alias("slide"), F.col("a").alias("__to")))
    return shapes.join(ends, ["deck", "slide"], "left").withColumn("slide", F.coalesce("__to", "slide")).drop("__to")


def drop_series(series: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop named chart series or diagram nodes: rows of a child table."""
    log = series.join(steps, [*KEY, "sname"]).groupBy(*KEY, "sname").agg(F.min("deg").alias("deg"), F.count(F.lit(1)).alias("points"))
    return series.join(log.select(*KEY, "sname"), [*KEY, "sname"], "left_anti"), log


def clear_notes(pages: DataFrame, steps: DataFrame, most: int = 400) -> tuple[DataFrame, DataFrame]:
    """Empty the notes of ``steps(deck, slide, deg)``; pages without words in their notes are not logged."""
    asked = steps.groupBy("deck", "slide").agg(F.min("deg").alias("deg"))
    was = F.trim("notes")
    log = pages.join(asked, ["deck", "slide"]).where(was != "").select("deck", "slide", "deg", F.substring(was, 1, most).alias("was"))
    marked = pages.join(log.select("deck", "slide", F.lit(True).alias("__x")), ["deck", "slide"], "left")
    return marked.withColumn("notes", F.when(F.col("__x"), "").otherwise(F.col("notes"))).drop("__x"), log


def layout_edit(layouts: DataFrame, pages: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove top-level shapes of layouts that ``steps(deck, layout, path, deg)`` name; what lies in them goes too.

    The log has one row per removed shape with ``affects``, how many of ``pages(deck, slide, layout)`` inherit it.
    A path that the layout does not have is passed over.
    """
    where = ["deck", "layout", "path"]
    asked = steps.groupBy(*where).agg(F.min("deg").alias("deg"))
    used = pages.groupBy("deck", "layout").agg(F.count(F.lit(1)).alias("affects"))
    log = (layouts.where(F.col("grp").isNull()).join(asked, where).join(used, ["deck", "layout"], "left").fillna(0, ["affects"])
           .select(*where, "deg", "kind", "name", "affects"))
    left = layouts.withColumn("__top", F.substring_index("path", "/", 1)).join(
        log.select("deck", "layout", F.col("path").alias("__top")), ["deck", "layout", "__top"], "left_anti")
    return left.select(*layouts.columns), log


def drop_nodes(nodes: DataFrame, links: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Diagram nodes whose text ``steps(KEY, t, deg)`` names go with every connection that touches them.

    ``nodes(KEY, node, ord, t)`` close up in order; ``links(KEY, a, b)`` join node ids.  The log has one row per node
    with the number of its connections.
    """
    gone = nodes.join(steps.groupBy(*KEY, "t").agg(F.min("deg").alias("deg")), [*KEY, "t"])
    ends = links.withColumn("node", F.explode(F.array_distinct(F.array("a", "b"))))
    cut = ends.join(gone.select(*KEY, "node"), [*KEY, "node"])
    log = gone.join(cut.groupBy(*KEY, "node").agg(F.count(F.lit(1)).alias("links")), [*KEY, "node"], "left").fillna(0, ["links"]).select(
        *KEY, "node", "t", "deg", "links")
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy("ord", "node")) - 1
    left = nodes.join(gone.select(*KEY, "node"), [*KEY, "node"], "left_anti").withColumn("ord", place.cast("long"))
    return left.select(*nodes.columns), links.join(cut.select(*KEY, "a", "b").distinct(), [*KEY, "a", "b"], "left_anti"), log


def strip_elements(elements: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chart elements ``steps(KEY, element, deg)``, titles or legends for instance, are taken out; absent ones are not logged."""
    log = elements.join(steps.groupBy(*KEY, "element").agg(F.min("deg").alias("deg")), [*KEY, "element"]).select(*KEY, "element", "deg", F.col("value").alias("was"))
    return elements.join(log.select(*KEY, "element"), [*KEY, "element"], "left_anti"), log
