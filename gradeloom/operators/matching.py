"""One-to-one pairing of two snapshots, page by page."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gradeloom.functions.geometry import boxes_meet, covers, inside, same_place
from gradeloom.functions.page_walk import SIDE, key_at, paired_tables
from gradeloom.functions.text import squeeze
from gradeloom.operators.structure import identity_keys, is_strong
from gradeloom.session import cut_lineage

#: Pages up to this many shapes are paired by one ordered walk; larger ones in rounds.
FOLD_SHAPES = 2000
PAIR_ORDER = ("rank", "dist2", "gt_path", "other_z", "other_path")
DRIFT_ORDER = ("gt_z", "gt_path", "rank", "dist2", "other_z", "other_path")
# When a page counts as itself.
ORDER_MARGIN, ORDER_EVIDENCE = 0.20, 2


def with_keys(shapes: DataFrame) -> DataFrame:
    return shapes.withColumn("keys", identity_keys())


def proposals(gt: DataFrame, other: DataFrame, by: Sequence[str], gt_by: Sequence[str] | None = None,
              weak_must_meet: bool = True) -> DataFrame:
    """Possible pairs of a page with the best-ranked key both shapes carry.

    A pairing on a weak key stands only where the boxes meet.  ``by`` are the keys of ``other``;
    ``gt`` may carry fewer of them (no scenario), given as ``gt_by``.
    """
    gt_by = list(gt_by or by)
    box = ("cx", "cy", "w", "h")
    left = gt.select(*gt_by, F.col("path").alias("gt_path"), F.col("z").alias("gt_z"), F.col("keys").alias("a_keys"),
                     *[F.col(c).alias(f"a_{c}") for c in box], F.posexplode("keys").alias("rank", "key"))
    right = other.select(*by, F.col("path").alias("other_path"), F.col("z").alias("other_z"), F.col("keys").alias("b_keys"),
                         *[F.col(c).alias(f"b_{c}") for c in box], F.explode("keys").alias("key"))
    # of the keys two shapes share, the row of the strongest one stays
    best = F.try_element_at(F.array_intersect("a_keys", "b_keys"), F.lit(1))
    pairs = left.join(right, [*gt_by, "key"]).where(F.col("key") == best)
    dx, dy = F.col("a_cx") - F.col("b_cx"), F.col("a_cy") - F.col("b_cy")
    pairs = pairs.withColumn("strong", is_strong(F.col("key"))).withColumn(
        "dist2", F.coalesce(dx * dx + dy * dy, F.lit(0)))
    if weak_must_meet:
        pairs = pairs.where(F.col("strong") | boxes_meet("a_", "b_"))
    return pairs.select(*by, "gt_path", "other_path", "rank", "dist2", "gt_z", "other_z", "key", "strong")


def _oversize(gt: DataFrame, other: DataFrame, by: Sequence[str], gt_by: Sequence[str]) -> DataFrame:
    n = F.count(F.lit(1))
    left = gt.groupBy(*gt_by).agg(n.alias("n")).where(F.col("n") > FOLD_SHAPES).select(*gt_by)
    right = other.groupBy(*by).agg(n.alias("n")).where(F.col("n") > FOLD_SHAPES).select(*gt_by)
    return left.unionByName(right).distinct()


def _fold(props: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Walk a page's proposals in order and accept each whose two ends are free."""
    item = F.struct(*order, *[c for c in ("gt_path", "other_path", "key", "strong") if c not in order])
    empty = F.array().cast("array<string>")
    out_type = "array<struct<gt_path:string,other_path:string,key:string,strong:boolean>>"
    start = F.struct(empty.alias("g"), empty.alias("o"), F.array().cast(out_type).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        free = ~F.array_contains(acc["g"], x["gt_path"]) & ~F.array_contains(acc["o"], x["other_path"])
        return F.when(free, F.struct(
            F.array_append(acc["g"], x["gt_path"]).alias("g"), F.array_append(acc["o"], x["other_path"]).alias("o"),
            F.array_append(acc["out"], F.struct(x["gt_path"].alias("gt_path"), x["other_path"].alias("other_path"),
                                                x["key"].alias("key"), x["strong"].alias("strong"))).alias("out"))).otherwise(acc)

    return (props.groupBy(*by).agg(F.sort_array(F.collect_list(item)).alias("p"))
            .select(*by, F.explode(F.aggregate("p", start, step)["out"]).alias("x")).select(*by, "x.*"))


#: What the walk itself reads of a shape.
ENDS = ("path", "z", "keys", "cx", "cy", "w", "h")
#: What the identities of a shape are made of; they take less room on the way than the identities do.
NAMED_BY = ("placeholder", "blob", "kind", "plain", "name", "w", "h")


def _both(gt: DataFrame, other: DataFrame, by: Sequence[str], gt_by: Sequence[str], cols: Sequence[str], own: Sequence[str] = (),
          both: Callable[[Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """Shapes of both sides, dealt out by page once; the rows of a page follow one another.

    Sides without ``keys`` get their identities behind the shuffle.  ``own`` are columns that only ``gt`` has.  ``both`` gives
    the rows of the two sides for the names of columns, where one table holds them.
    """
    extra, keyed = [c for c in by if c not in gt_by], "keys" in gt.columns
    wanted = list(dict.fromkeys([*ENDS, *cols]))
    if both is not None:
        rows = both(list(dict.fromkeys([*[c for c in wanted if c != "keys"], *NAMED_BY])))
        # a window asks for whole pages in order, and for a shuffle only where the rows are not dealt out by page yet
        rows = rows.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*gt_by)))
        return with_keys(rows).select(*gt_by, *wanted, SIDE, "__n")
    names = [*gt_by, *(wanted if keyed else dict.fromkeys([c for c in wanted if c != "keys"] + list(NAMED_BY)))]
    rows = gt.select(*names, *own, F.lit(0).cast("byte").alias(SIDE)).unionByName(
        other.select(*names, *extra, F.lit(1).cast("byte").alias(SIDE)), allowMissingColumns=True)
    # a number sorts faster than the names of decks, which begin alike
    rows = rows.repartition(*gt_by).sortWithinPartitions(F.xxhash64(*gt_by), *gt_by)
    return rows if keyed else with_keys(rows).select(*gt_by, *wanted, *own, *extra, SIDE)


def _walked(gt: DataFrame, other: DataFrame, by: Sequence[str], gt_by: Sequence[str], order: Sequence[str], weak_must_meet: bool,
            both: Callable[[Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """The accepted pairs of pages that one task holds whole."""
    rows, extra = _both(gt, other, by, gt_by, (), both=both), [c for c in by if c not in gt_by]
    types = {f.name: f.dataType for f in rows.schema}
    schema = StructType([*[StructField(c, types[c]) for c in by], StructField("gt_path", types["path"]), StructField("other_path", types["path"]), StructField("key", StringType())])

    def made(table, a, b, rank):
        import pyarrow as pa

        cells = [table[c].take(pa.array(b)) for c in by] + [table["path"].take(pa.array(a)), table["path"].take(pa.array(b)), key_at(table, a, rank)]
        return pa.table(cells, names=schema.names)

    out = rows.mapInArrow(paired_tables(list(gt_by), extra, tuple(order) == PAIR_ORDER, weak_must_meet, made), schema)
    return out.withColumn("strong", is_strong(F.col("key")))


def wide_pairs(gt: DataFrame, other: DataFrame, cols: Sequence[str], by: Sequence[str] = ("deck", "slide"), order: Sequence[str] = PAIR_ORDER,
               weak_must_meet: bool = True, alone: bool = False, big: DataFrame | None = None,
               both: Callable[[Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """``side_by_side`` of the pairing in one pass: a_* and b_* of ``cols`` and the path, key and strong.

    One row per gt shape; with ``alone`` also each shape of ``other`` that nothing took, its a_* null.  Both sides have
    ``keys``, the strong ones first, or neither and are paired by their identities.  ``big(by)`` are the pages that may be too large for a task, if known; else they are counted.
    ``both`` gives the rows of both sides for the names of columns, where one table holds them; it is not used where pages are too large.
    """
    by = list(by)
    if big is None:
        big = _oversize(gt, other, by, by)
    large = not big.isEmpty()
    if large:
        big = cut_lineage(big)
    names = list(dict.fromkeys(["path", *cols]))
    halves = [[side.join(big, by, how) for side in (gt, other)] for how in ("left_anti", "left_semi")] if large else [[gt, other]]
    rows = _both(*halves[0], by, by, cols, both=None if large else both)
    types = {f.name: f.dataType for f in rows.schema}
    schema = StructType([*[StructField(c, types[c]) for c in by], *[StructField(f"{m}_{c}", types[c]) for m in "ab" for c in names], StructField("key", StringType())])

    def made(table, a, b, rank):
        import numpy as np
        import pyarrow as pa

        side = table[SIDE].to_numpy()
        peer, at = np.full(len(side), -1), np.full(len(side), -1)
        peer[a], at[a] = b, rank
        left = np.flatnonzero(side == 0)
        right, at = peer[left], at[left]
        if alone:
            rest = side == 1
            rest[b] = False
            rest = np.flatnonzero(rest)
            none = np.full(len(rest), -1)
            left, right, at = np.r_[left, none], np.r_[right, rest], np.r_[at, none]
        take = lambda c, i: table[c].take(pa.array(i, mask=i < 0))
        cells = [take(c, np.where(left < 0, right, left)) for c in by] + [take(c, i) for i in (left, right) for c in names]
        return pa.table([*cells, key_at(table, left, at)], names=schema.names)

    out = rows.mapInArrow(paired_tables(by, [], tuple(order) == PAIR_ORDER, weak_must_meet, made), schema)
    if large:
        pairs = pair(*[side if "keys" in gt.columns else with_keys(side) for side in halves[1]], by, order=order, weak_must_meet=weak_must_meet)
        narrow = [side.select(*by, *names) for side in halves[1]]
        out = out.unionByName(side_by_side(*narrow, pairs, by).drop("strong"))
        if alone:
            left = narrow[1].join(pairs.select(*by, F.col("other_path").alias("path")), [*by, "path"], "left_anti")
            out = out.unionByName(left.select(*by, *[F.col(c).alias(f"b_{c}") for c in names]), allowMissingColumns=True)
    return out.withColumn("strong", is_strong(F.col("key")))


def wide_scenarios(gt: DataFrame, frames: DataFrame, names: Sequence[str], cols: Sequence[str], own: Sequence[str] = (), order: Sequence[str] = PAIR_ORDER,
                   unless: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """``wide_pairs`` of every scenario of ``frames`` against the one answer, in one pass over the shapes.

    For each of ``names``, a handful, one row per gt shape and one per shape of the scenario that nothing took, its a_* null.  ``own`` are
    further columns of the answer's shapes.  Neither side has ``keys``.  With ``unless``, a mark among ``own`` and some of ``cols``, the rows of unmarked
    shapes whose counterpart is there and equal in all of these are left out.
    """
    by, page, names, cols = ["scenario", "deck", "slide"], ["deck", "slide"], list(names), list(dict.fromkeys(["path", *cols]))
    big = _oversize(gt, frames, by, page)
    large = not big.isEmpty()
    if large:
        big = cut_lineage(big)
    halves = [[side.join(big, page, how) for side in (gt, frames)] for how in ("left_anti", "left_semi")] if large else [[gt, frames]]
    rows = _both(*halves[0], by, page, cols, own)
    types = {f.name: f.dataType for f in rows.schema}
    schema = StructType([*[StructField(c, types[c]) for c in by], *[StructField(f"{m}_{c}", types[c]) for m in "ab" for c in cols],
                         *[StructField(c, types[c]) for c in own], StructField("key", StringType())])

    def made(table, a, b, rank):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        side, known = table[SIDE].to_numpy(), pa.array(names, pa.string())
        scene = pc.index_in(table["scenario"].combine_chunks().cast(pa.string()), known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        left, at = np.flatnonzero(side == 0), np.full(len(side), -1)
        at[left] = np.arange(len(left))
        peer, place = np.full((len(names), len(left)), -1), np.full((len(names), len(left)), -1)
        peer[scene[b], at[a]], place[scene[b], at[a]] = b, rank
        rest = side == 1
        rest[b] = False
        rest = np.flatnonzero(rest)
        none = np.full(len(rest), -1)
        which = np.r_[np.repeat(np.arange(len(names)), len(left)), scene[rest]]
        left, right, place = np.r_[np.tile(left, len(names)), none], np.r_[peer.ravel(), rest], np.r_[place.ravel(), none]
        if unless is not None:
            marked = table[unless[0]].combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
            kept = (left < 0) | (right < 0) | marked[left]
            for c in unless[1]:
                codes = table[c].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                kept |= codes[left] != codes[right]
            which, left, right, place = which[kept], left[kept], right[kept], place[kept]
        take = lambda c, i: table[c].take(pa.array(i, mask=i < 0))
        cells = [known.take(pa.array(which))] + [take(c, np.where(left < 0, right, left)) for c in page] + [take(c, i) for i in (left, right) for c in cols]
        return pa.table([*cells, *[take(c, left) for c in own], key_at(table, left, place)], names=schema.names)

    out = rows.mapInArrow(paired_tables(page, ["scenario"], tuple(order) == PAIR_ORDER, True, made), schema)
    if large:
        left, right = (with_keys(side) for side in halves[1])
        pairs = pair(left, right, by, page, order=order)
        scenes = gt.sparkSession.createDataFrame([(n,) for n in names], "scenario string")
        narrow = [left.select(*page, *cols, *own), right.select(*by, *cols)]
        rows = side_by_side(*narrow, pairs, by, page, scenes)
        if unless is not None:
            told = F.coalesce(F.col(f"a_{unless[0]}"), F.lit(False)) | F.col("b_path").isNull()
            for c in unless[1]:
                told = told | ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
            rows = rows.where(told)
        out = out.unionByName(rows.select(*[F.col(f"a_{c}").alias(c) if c in own else F.col(c) for c in schema.names]))
        loose = narrow[1].join(pairs.select(*by, F.col("other_path").alias("path")), [*by, "path"], "left_anti")
        out = out.unionByName(loose.select(*by, *[F.col(c).alias(f"b_{c}") for c in cols]), allowMissingColumns=True)
    return out.withColumn("strong", is_strong(F.col("key")))


def _rounds(props: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same choice made in rounds: a proposal that is first for both its ends is accepted.

    Under one strict order this gives exactly the fold's result, and no page is gathered in one task.
    """
    rank = F.struct(*order)
    left, taken = cut_lineage(props), None
    while not left.isEmpty():
        by_gt = left.groupBy(*by, "gt_path").agg(F.min(rank).alias("best_g"))
        by_other = left.groupBy(*by, "other_path").agg(F.min(rank).alias("best_o"))
        won = cut_lineage(left.join(by_gt, [*by, "gt_path"]).join(by_other, [*by, "other_path"])
                          .where((rank == F.col("best_g")) & (rank == F.col("best_o"))).drop("best_g", "best_o"))
        taken = won if taken is None else taken.unionByName(won)
        left = cut_lineage(left.join(won.select(*by, "gt_path"), [*by, "gt_path"], "left_anti")
                           .join(won.select(*by, "other_path"), [*by, "other_path"], "left_anti"))
    return (props.limit(0) if taken is None else taken).select(*by, "gt_path", "other_path", "key", "strong")


#: Cell sizes, as powers of two, of the grids that the nearest centre is looked for on.
LEVELS = (0, 4, 8, *range(10, 27), 32, 40, 50, 62)


def _cells(points: DataFrame, levels: Column, reach: int) -> DataFrame:
    """The cell of each centre on each of its levels, and those up to ``reach`` cells away."""
    near = F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x in range(-reach, reach + 1) for y in range(-reach, reach + 1)])
    rows = points.withColumn("level", F.explode(levels))
    rows = rows.withColumn("near", F.explode(near)) if reach else rows.withColumn("near", F.struct(F.lit(0).alias("dx"), F.lit(0).alias("dy")))
    cell = lambda c: F.expr(f"shiftright({c}, level)")
    return rows.withColumn("x", cell("cx") + F.col("near.dx")).withColumn("y", cell("cy") + F.col("near.dy")).drop("near")


def nearest_centres(here: DataFrame, there: DataFrame, on: Sequence[str]) -> DataFrame:
    """(on, cx, cy, to_cx, to_cy): for every centre of ``here`` all nearest ones of ``there`` with equal ``on``.

    The finest grid on which a neighbouring cell is taken bounds the distance to under three cells, and only the
    cells within that reach are opened.
    """
    on = list(on)
    p, q = here.select(*on, "cx", "cy").distinct(), there.select(*on, "cx", "cy").distinct()
    same = p.join(q, [*on, "cx", "cy"])
    apart = p.join(same, [*on, "cx", "cy"], "left_anti")
    levels = F.array(*[F.lit(x) for x in LEVELS])
    homes = _cells(q.select(*on, "cx", "cy"), levels, 0)
    taken = homes.select(*on, "level", "x", "y").distinct()
    reach = (_cells(apart, levels, 1).join(taken, [*on, "level", "x", "y"])
             .groupBy(*on, "cx", "cy").agg(F.min("level").alias("least")))
    met = (_cells(reach, F.array("least"), 3)
           .join(homes.select(*on, "level", "x", "y", F.col("cx").alias("to_cx"), F.col("cy").alias("to_cy")), [*on, "level", "x", "y"])
           .withColumn("d", (F.col("cx") - F.col("to_cx")) * (F.col("cx") - F.col("to_cx")) + (F.col("cy") - F.col("to_cy")) * (F.col("cy") - F.col("to_cy"))))
    best = met.groupBy(*on, "cx", "cy").agg(F.min("d").alias("least_d"))
    far = met.join(best, [*on, "cx", "cy"]).where(F.col("d") == F.col("least_d")).select(*on, "cx", "cy", "to_cx", "to_cy")
    return same.select(*on, "cx", "cy", F.col("cx").alias("to_cx"), F.col("cy").alias("to_cy")).unionByName(far)


def _meeting(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Pairs of boxes with equal ``on`` that may meet, from grids as coarse as the larger box of the two."""
    top = 62
    def level(c):
        # two boxes that meet are no further apart than the larger one's size and the tolerance
        return F.least(F.lit(top), F.ceil(F.log2(F.greatest(F.col("w"), F.col("h"), F.lit(0)) + 2.0 * 9144 + 1)).cast("int"))
    a, b = a.withColumn("own", level("a")), b.withColumn("own", level("b"))
    names = lambda df, mark: df.select(*on, *[F.col(c).alias(f"{mark}{c}") for c in df.columns if c not in on])
    out = None
    for home, guest, marks, equal in ((a, b, ("a_", "b_"), True), (b, a, ("b_", "a_"), False)):
        used = home.select(*on, F.col("own").alias("level")).distinct()
        at = names(_cells(home, F.array("own"), 0).withColumn("own", F.col("level")), marks[0])
        at = at.select(*on, *[F.col(c) for c in at.columns if c not in on and c[2:] not in ("level", "x", "y")],
                       F.col(f"{marks[0]}level").alias("level"), F.col(f"{marks[0]}x").alias("x"), F.col(f"{marks[0]}y").alias("y"))
        went = guest.join(used, list(on)).where((F.col("own") <= F.col("level")) if equal else (F.col("own") < F.col("level")))
        went = _cells(went.withColumnRenamed("level", "to"), F.array("to"), 1).drop("to")
        went = names(went, marks[1])
        went = went.select(*on, *[F.col(c) for c in went.columns if c not in on and c[2:] not in ("level", "x", "y")],
                           F.col(f"{marks[1]}level").alias("level"), F.col(f"{marks[1]}x").alias("x"), F.col(f"{marks[1]}y").alias("y"))
        got = at.join(went, [*on, "level", "x", "y"]).drop("level", "x", "y", "a_own", "b_own")
        out = got if out is None else out.unionByName(got)
    return out.where(boxes_meet("a_", "b_"))


def _by_distance(gt: DataFrame, other: DataFrame, by: Sequence[str], gt_by: Sequence[str], weak_must_meet: bool) -> DataFrame:
    """The pairing by ``PAIR_ORDER`` without all pairs of shapes that share a key; every shape needs a box.

    Key ranks go one after the other.  Shapes that no order but their own tells apart form a class: equal key and
    place.  In rounds, a class of each side that are nearest to one another and to no other pair all they can, in
    their order; where several are equally near, the first shapes of all do.  A round compares classes with their
    nearest ones only.
    """
    by, box = list(by), ["cx", "cy", "w", "h"]
    free_a = cut_lineage(gt.join(other.select(*by).distinct(), list(gt_by)).select(*by, "path", "keys", *box))
    free_b = cut_lineage(other.select(*by, "path", "z", "keys", *box))
    ranks, taken = free_a.agg(F.max(F.size("keys"))).first()[0] or 0, []
    weak = lambda key: ~is_strong(key) if weak_must_meet else F.lit(False)
    for rank in range(ranks):
        while True:
            # w and h tell apart only where boxes must meet
            a = free_a.where(F.size("keys") > rank).withColumn("key", F.get("keys", F.lit(rank))).drop("keys").withColumn("weak", weak(F.col("key")))
            for c in ("w", "h"):
                a = a.withColumn(c, F.when(F.col("weak"), F.col(c)).otherwise(0))
            wanted = a.select(*by, "key", "weak").distinct()
            b = (free_b.withColumn("key", F.explode(F.array_distinct("keys"))).drop("keys").join(wanted, [*by, "key"])
                 .groupBy(*by, "path", "z", *box).agg(F.sort_array(F.collect_list("key")).alias("wants"), F.max("weak").alias("weak")))
            for c in ("w", "h"):
                b = b.withColumn(c, F.when(F.col("weak"), F.col(c)).otherwise(0))
            b = cut_lineage(b)
            if b.isEmpty():
                break
            class_a = a.groupBy(*by, "key", "weak", *box).agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first"))
            class_b = b.groupBy(*by, "wants", *box).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("z", "path")).alias("first"))
            keyed_b = class_b.withColumn("key", F.explode("wants")).withColumn("weak", weak(F.col("key")))
            class_a, keyed_b, on = cut_lineage(class_a), cut_lineage(keyed_b), [*by, "key"]
            strong_a, strong_b = class_a.where("not weak"), keyed_b.where("not weak")
            links = nearest_centres(strong_a, strong_b, on).select(*on, F.col("cx").alias("a_cx"), F.col("cy").alias("a_cy"), F.col("to_cx").alias("b_cx"), F.col("to_cy").alias("b_cy")).unionByName(
                nearest_centres(strong_b, strong_a, on).select(*on, F.col("cx").alias("b_cx"), F.col("cy").alias("b_cy"), F.col("to_cx").alias("a_cx"), F.col("to_cy").alias("a_cy"))).distinct()
            side = lambda df, m: df.select(*on, *[F.col(c).alias(f"{m}{c}") for c in df.columns if c not in (*on, "weak")])
            pairs = links.join(side(strong_a, "a_"), [*on, "a_cx", "a_cy"]).join(side(strong_b, "b_"), [*on, "b_cx", "b_cy"])
            if weak_must_meet:
                pairs = pairs.unionByName(_meeting(class_a.where("weak").drop("weak"), keyed_b.where("weak").drop("weak"), on))
            dx, dy = F.col("a_cx") - F.col("b_cx"), F.col("a_cy") - F.col("b_cy")
            at_a, at_b = [*on, "a_cx", "a_cy", "a_w", "a_h"], [*by, "b_wants", "b_cx", "b_cy", "b_w", "b_h"]
            pairs = cut_lineage(pairs.withColumn("order", F.struct((dx * dx + dy * dy).alias("d"), F.col("a_first").alias("p"), F.col("b_first").alias("q"))))
            if pairs.isEmpty():
                break
            for at, name in ((at_a, "by_a"), (at_b, "by_b")):
                near = pairs.groupBy(*at).agg(F.min("order").alias(name))
                ties = pairs.join(near, at).where(F.col("order.d") == F.col(f"{name}.d")).groupBy(*at).agg(F.first(name).alias(name), F.count(F.lit(1)).alias(f"{name}_ties"))
                pairs = pairs.join(ties, at)
            alone = (F.col("by_a_ties") == 1) & (F.col("by_b_ties") == 1)
            won = cut_lineage(pairs.where((F.col("order") == F.col("by_a")) & (F.col("order") == F.col("by_b")))
                              .select(*on, *[c for c in at_a + at_b if c not in on], F.when(alone, F.least("a_n", "b_n")).otherwise(1).alias("m")))
            place = [*by, "key", *box]
            nth_a = a.withColumn("nth", F.row_number().over(Window.partitionBy(*place).orderBy("path")))
            nth_b = b.withColumn("nth", F.row_number().over(Window.partitionBy(*by, "wants", *box).orderBy("z", "path")))
            rows_a = nth_a.select(*on, *[F.col(c).alias(f"a_{c}") for c in box], F.col("path").alias("gt_path"), "nth")
            rows_b = nth_b.select(*by, "nth", F.col("path").alias("other_path"), F.col("wants").alias("b_wants"), *[F.col(c).alias(f"b_{c}") for c in box])
            got = cut_lineage(won.join(rows_a, at_a).where(F.col("nth") <= F.col("m")).join(rows_b, [*at_b, "nth"]).select(*by, "gt_path", "other_path", "key"))
            taken.append(got)
            free_a = cut_lineage(free_a.join(got.select(*by, F.col("gt_path").alias("path")), [*by, "path"], "left_anti"))
            free_b = cut_lineage(free_b.join(got.select(*by, F.col("other_path").alias("path")), [*by, "path"], "left_anti"))
    cells = [*[free_b[c] for c in by], F.col("path").alias("gt_path"), F.col("path").alias("other_path"), F.lit("").alias("key")]
    out = free_b.select(*cells).limit(0)
    for got in taken:
        out = out.unionByName(got)
    return out.withColumn("strong", is_strong(F.col("key")))


def pair(gt: DataFrame, other: DataFrame, by: Sequence[str] = ("deck", "slide"),
         gt_by: Sequence[str] | None = None, order: Sequence[str] = PAIR_ORDER,
         weak_must_meet: bool = True, big: DataFrame | None = None, both: Callable[[Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """Accepted pairs (by, gt_path, other_path, key, strong): strongest key first, nearest first.

    Both sides have ``keys``, the strong ones first, or neither and are paired by their identities.  Pages are walked whole, after one shuffle of the shapes; ``big``
    are the pages that may be too large for a task, if known, else one count finds them.  Large pages are paired by nearest classes; those that hold a shape without a box, which is near to all,
    and all large ones under another order, in rounds over their proposals.
    """
    gt_by, by = list(gt_by or by), list(by)
    if big is None:
        big = _oversize(gt, other, by, gt_by)
    if big.isEmpty():
        return _walked(gt, other, by, gt_by, order, weak_must_meet, both)
    big = cut_lineage(big)
    odd = big
    if tuple(order) == PAIR_ORDER:
        boxless = F.col("cx").isNull() | F.col("cy").isNull() | F.col("w").isNull() | F.col("h").isNull()
        odd = cut_lineage(gt.where(boxless).select(*gt_by).unionByName(other.where(boxless).select(*gt_by)).distinct().join(big, gt_by, "left_semi"))
    plain = big.join(odd, gt_by, "left_anti")
    walked = [gt, other]
    if "keys" not in gt.columns:
        gt, other = with_keys(gt), with_keys(other)
    out = _walked(*[side.join(big, gt_by, "left_anti") for side in walked], by, gt_by, order, weak_must_meet)
    if not odd.isEmpty():
        out = out.unionByName(_rounds(proposals(*[side.join(odd, gt_by, "left_semi") for side in (gt, other)], by, gt_by, weak_must_meet), by, order))
    if not plain.isEmpty():
        out = out.unionByName(_by_distance(*[side.join(plain, gt_by, "left_semi") for side in (gt, other)], by, gt_by, weak_must_meet))
    return out


def match_shapes(before: DataFrame, after: DataFrame, by: Sequence[str] = ("deck", "slide"), big: DataFrame | None = None,
                 both: Callable[[Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """Every shape of both sides once: in page order each takes the nearest free shape on its
    strongest shared key; what is left over stands alone."""
    got = wide_pairs(before, after, (), by, order=DRIFT_ORDER, weak_must_meet=False, alone=True, big=big, both=both)
    return got.select(*by, F.col("a_path").alias("gt_path"), F.col("b_path").alias("other_path"), "key")


def side_by_side(gt: DataFrame, other: DataFrame, pairs: DataFrame, by: Sequence[str] = ("deck", "slide"),
                 gt_by: Sequence[str] | None = None, scenarios: DataFrame | None = None) -> DataFrame:
    """One row per gt shape (and scenario) with a_* columns, and b_* columns of its counterpart."""
    gt_by = list(gt_by or by)
    cols = [c for c in gt.columns if c not in ("deck", "slide", "scenario", "keys")]
    a = gt.select(*gt_by, *[F.col(c).alias(f"a_{c}") for c in cols])
    b = other.select(*by, *[F.col(c).alias(f"b_{c}") for c in other.columns if c not in ("deck", "slide", "scenario", "keys")])
    if scenarios is not None:
        a = a.join(F.broadcast(scenarios), how="cross")       # a handful of named scenarios
    link = pairs.select(*by, F.col("gt_path").alias("a_path"), F.col("other_path").alias("b_path"), "key", "strong")
    return a.join(link, [*by, "a_path"], "left").join(b, [*by, "b_path"], "left")


# ------------------------------------------------------------------ pages

def page_signatures(shapes: DataFrame, by: Sequence[str] = ("deck", "slide")) -> DataFrame:
    """(by, mark): the distinct text digests of a page, as rows."""
    text = squeeze(F.col("plain"))
    return (shapes.where(text != "").select(*by, F.substring(F.sha2(text, 256), 1, 8).alias("mark")).distinct())


def page_overlap(gt: DataFrame, mine: DataFrame) -> DataFrame:
    """Jaccard of every gt page with every page of mine that shares a mark, plus sizes.

    The pair list comes from an equi-join on marks, so pages with nothing in common never meet.
    """
    size_g = gt.groupBy("deck", "slide").agg(F.count("mark").alias("n_gt"))
    size_m = mine.groupBy("deck", "slide").agg(F.count("mark").alias("n_mine"))
    shared = (gt.select("deck", F.col("slide").alias("gt_slide"), "mark")
              .join(mine.select("deck", F.col("slide").alias("my_slide"), "mark"), ["deck", "mark"])
              .groupBy("deck", "gt_slide", "my_slide").agg(F.count(F.lit(1)).alias("both")))
    return (shared.join(size_g.withColumnRenamed("slide", "gt_slide"), ["deck", "gt_slide"])
            .join(size_m.withColumnRenamed("slide", "my_slide"), ["deck", "my_slide"])
            .withColumn("overlap", F.col("both") / (F.col("n_gt") + F.col("n_mine") - F.col("both"))))


def page_is_itself(gt_pages: DataFrame, gt: DataFrame, mine: DataFrame) -> DataFrame:
    """Whether page ``slide`` of mine is gt page ``slide``: best match, or within the margin of it.

    ``gt_pages(deck, slide)`` lists the pages asked about; a page with too little text passes.
    """
    # dealt out by deck once; all that follows reads the whole marks, so that it shares the one shuffle
    gt, mine = gt.repartition("deck"), mine.repartition("deck")
    evidence = gt.groupBy("deck", "slide").agg(F.count("mark").alias("marks"))
    have = mine.groupBy("deck", "slide").agg(F.count("mark").alias("mine_marks"))
    over = page_overlap(gt, mine)
    here = over.where(F.col("gt_slide") == F.col("my_slide")).select("deck", F.col("my_slide").alias("slide"), F.col("overlap").alias("here"))
    best = over.groupBy("deck", F.col("my_slide").alias("slide")).agg(F.max("overlap").alias("best"))
    # two pages without any text overlap fully, which only matters when mine is empty
    textless = (gt_pages.join(evidence, ["deck", "slide"], "left").where(F.col("marks").isNull())
                .groupBy("deck").agg(F.lit(True).alias("some_textless")))
    rows = (gt_pages.join(evidence, ["deck", "slide"], "left").join(have, ["deck", "slide"], "left")
            .join(here, ["deck", "slide"], "left").join(best, ["deck", "slide"], "left").join(textless, "deck", "left"))
    top = F.when(F.coalesce("mine_marks", F.lit(0)) == 0, F.when(F.col("some_textless"), 1.0).otherwise(0.0)).otherwise(
        F.coalesce("best", F.lit(0.0)))
    thin = F.coalesce("marks", F.lit(0)) < ORDER_EVIDENCE
    return rows.select("deck", "slide", (thin | (top <= F.coalesce("here", F.lit(0.0)) + ORDER_MARGIN)).alias("itself"),
                       F.coalesce("here", F.lit(0.0)).alias("here"), top.alias("best"), (~thin).alias("judged"))


def slide_map(edits: DataFrame, pages: DataFrame) -> DataFrame:
    """(deck, slide, init_slide): where each gt page is in the broken file.

    Deletions, then swaps, replayed by position.  ``edits(deck, ord, kind, a, b)`` are a deck's few
    deck-level steps; ``pages(deck, n_pages)``.
    """
    steps = edits.groupBy("deck").agg(F.array_sort(F.collect_list(F.struct(
        F.when(F.col("kind") == "delete", 0).otherwise(1).alias("phase"), "ord", "kind", "a", "b"))).alias("steps"))
    rows = pages.join(steps, "deck", "left")
    order = F.sequence(F.lit(0).cast("long"), F.col("n_pages") - 1)

    def step(acc: Column, s: Column) -> Column:
        gone = F.filter(acc, lambda p: p != s["a"])
        x, y = F.get(acc, s["a"].cast("int")), F.get(acc, s["b"].cast("int"))
        swapped = F.transform(acc, lambda p: F.when(p == x, y).when(p == y, x).otherwise(p))
        ok = x.isNotNull() & y.isNotNull()
        return F.when(s["kind"] == "delete", gone).when(ok, swapped).otherwise(acc)

    final = F.aggregate(F.coalesce("steps", F.array().cast("array<struct<phase:int,ord:bigint,kind:string,a:bigint,b:bigint>>")), order, step)
    placed = rows.select("deck", "n_pages", final.alias("final"))
    return placed.select("deck", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n_pages") - 1),
        lambda p: F.struct(p.alias("slide"), F.nullif(F.array_position(placed["final"], p) - 1, F.lit(-1)).alias("init_slide")))).alias("m")).select("deck", "m.*")


def relatives(shapes: DataFrame) -> DataFrame:
    """(deck, slide, path, relation, other): members of a container and siblings of a shape."""
    parent = F.when(F.contains("path", F.lit("/")), F.regexp_extract("path", "^(.*)/[^/]*$", 1)).otherwise("")
    rows = shapes.select("deck", "slide", "path", "z", parent.alias("parent"))
    members = rows.where(F.col("parent") != "").select("deck", "slide", F.col("parent").alias("path"), F.lit("member").alias("relation"), F.col("path").alias("other"))
    return members


def sibling_counts(shapes: DataFrame) -> DataFrame:
    """How many siblings each shape has under its parent; counted, not paired."""
    parent = F.when(F.contains("path", F.lit("/")), F.regexp_extract("path", "^(.*)/[^/]*$", 1)).otherwise("")
    rows = shapes.select("deck", "slide", "path", parent.alias("parent"))
    sizes = rows.groupBy("deck", "slide", "parent").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(sizes, ["deck", "slide", "parent"]).select("deck", "slide", "path", "parent", (F.col("n") - 1).alias("siblings"))


def box_relations(pairs: DataFrame) -> DataFrame:
    """The four box tests on a_* and b_* boxes."""
    return pairs.select("*", boxes_meet("a_", "b_").alias("meets"), inside("a_", "b_").alias("is_inside"),
                        same_place("a_", "b_").alias("at_same_place"), covers("a_", "b_").alias("is_cover"))
