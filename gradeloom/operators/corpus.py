"""Corpus intake and selection."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.ordered import first_per_key, ranked_rows
from gradeloom.functions.text import percent_encode
from gradeloom.operators import policies as P
from gradeloom.session import cut_lineage

INDEX_COLUMNS = ("filename", "size", "url", "license", "title", "created", "updated", "doi",
                 "checksum")


# ------------------------------------------------------------------ licence and duplicates

def licence_verdict(rows: DataFrame) -> DataFrame:
    """Add ok, family, share_alike and why.  An id nobody reviewed is refused, with its own reason."""
    policy = F.broadcast(P.licence_policy(rows.sparkSession))     # 36 fixed rows
    keyed = rows.withColumn("licence", F.lower(F.trim(F.coalesce("license", F.lit("")))))
    return (keyed.join(policy, "licence", "left")
            .withColumn("ok", F.coalesce("ok", F.lit(False)))
            .withColumn("share_alike", F.coalesce("share_alike", F.lit(False)))
            .withColumn("why", F.coalesce("why", F.lit(P.UNKNOWN_LICENCE))))


def dedup_first(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """Add ``is_first`` and ``winner``: the first row of a key in input order wins.

    A blank key never de-duplicates.  The winner of each key comes from an aggregate, so a key that
    holds a large share of the table is reduced before the shuffle; the join back is between a big
    side and one row per key, which adaptive execution splits when a key is hot.
    """
    keyed = rows.where(F.coalesce(F.col(key), F.lit("")) != "")
    blank = rows.where(F.coalesce(F.col(key), F.lit("")) == "")
    winners = first_per_key(keyed, [key], [order], [order, name]).select(
        F.col(key), F.col(order).alias("__first"), F.col(name).alias("winner"))
    judged = (keyed.join(winners, key)
              .withColumn("is_first", F.col(order) == F.col("__first"))
              .drop("__first"))
    blank = blank.withColumn("winner", F.col(name)).withColumn("is_first", F.lit(True))
    return judged.unionByName(blank)


def select_rows(rows: DataFrame) -> DataFrame:
    """Licence filter, then de-duplication of what passed; every row keeps its decision."""
    judged = licence_verdict(rows)
    refused = (judged.where(~F.col("ok"))
               .withColumn("kept", F.lit(False))
               .withColumn("reason", F.concat(F.lit("licence: "), "why")))
    passed = dedup_first(judged.where("ok"), "checksum", "ord", "filename")
    passed = (passed.withColumn("kept", F.col("is_first"))
              .withColumn("reason", F.when(~F.col("is_first"),
                                           F.concat(F.lit("duplicate of "), "winner")))
              .drop("is_first", "winner"))
    return passed.unionByName(refused)


def selection_audit(selected: DataFrame) -> DataFrame:
    """(metric, label, n): rows in and out, refusals by reason, kept rows by family, share-alike."""
    reason = F.when(F.col("reason").startswith("duplicate of"), F.lit("duplicate")).otherwise(
        F.col("reason"))
    labels = F.array(
        F.struct(F.lit("in").alias("metric"), F.lit("all").alias("label")),
        F.when(F.col("kept"), F.struct(F.lit("out").alias("metric"), F.lit("all").alias("label"))),
        F.when(F.col("kept"), F.struct(F.lit("family").alias("metric"), F.col("family").alias("label"))),
        F.when(F.col("kept") & F.col("share_alike"),
               F.struct(F.lit("share_alike").alias("metric"), F.lit("all").alias("label"))),
        F.when(~F.col("kept"), F.struct(F.lit("dropped").alias("metric"), reason.alias("label"))))
    return (selected.select(F.explode(F.filter(labels, lambda x: x.isNotNull())).alias("m"))
            .groupBy("m.metric", "m.label").agg(F.count(F.lit(1)).alias("n")))


def deck_path() -> Column:
    md5 = F.regexp_replace(F.coalesce("checksum", F.lit("")), "^md5:", "")
    year = F.substring(F.coalesce("created", F.lit("")), 1, 4)
    return F.concat(F.lit("pptx/"), F.coalesce("license", F.lit("None")), F.lit("/"), year,
                    F.lit("/"), md5, F.lit("-"), F.coalesce("filename", F.lit("None")))


def with_locations(rows: DataFrame, base: str) -> DataFrame:
    """Add ``path`` and the ordered places to fetch it from: the mirror, then the origin."""
    mirror = F.concat(F.lit(base), percent_encode(F.col("path")))
    origin = F.when(F.coalesce("url", F.lit("")) != "", F.col("url"))
    return (rows.withColumn("path", deck_path())
            .withColumn("urls", F.array_compact(F.array(mirror, origin))))


# ------------------------------------------------------------------ manifests and triage

# Part-name patterns counted in a manifest.
PART_PATTERNS = {
    "slides": r"^ppt/slides/slide[0-9]+\.xml$",
    "media": r"^ppt/media/",
    "charts": r"^ppt/charts/chart[0-9]+\.xml$",
    "diagrams": r"^ppt/diagrams/data[0-9]+\.xml$",
    "embeddings": r"^ppt/embeddings/",
    "notes": r"^ppt/notesSlides/notesSlide",
    "layouts": r"^ppt/slideLayouts/slideLayout",
}


def shape_counts(parts: DataFrame) -> DataFrame:
    """Per deck, how many parts of each kind its listing names."""
    return parts.groupBy("deck").agg(*[
        F.count_if(F.col("part").rlike(pattern)).alias(kind)
        for kind, pattern in PART_PATTERNS.items()])


def in_band(pages: Column) -> Column:
    return pages.between(*P.SLIDE_BAND)


def funnel_status(probed: Column, pages: Column, fetched: Column, readable: Column) -> Column:
    """How far a row got; each refusal is a settled answer and stays a row."""
    return (F.when(~probed, "probe_failed").when(~in_band(pages), "out_of_band")
            .when(~fetched, "download_failed").when(~readable, "unreadable")
            .otherwise("scored"))


def slide_features(features: DataFrame) -> DataFrame:
    """Add pasted, usable and rich flags to per-slide counts."""
    pasted = F.col("big_picture") & (F.col("content") <= 2)
    usable = (F.col("content") >= P.MIN_CONTENT) & ~pasted & (F.col("hard") <= P.MAX_HARD)
    rich = usable & ((F.col("aligned_groups") > 0) | (F.col("charts") > 0) | (F.col("tables") > 0)
                     | (F.col("diagrams") > 0) | (F.col("pictures") >= 2))
    return (features.withColumn("pasted", pasted).withColumn("usable", usable)
            .withColumn("rich", rich))


def triage_score(flagged: DataFrame) -> DataFrame:
    """One row per deck: saturating parts, penalties, score to one decimal and verdict."""
    per_deck = flagged.groupBy("deck").agg(
        F.count(F.lit(1)).alias("slides"),
        F.count_if("usable").alias("usable_slides"),
        F.count_if("rich").alias("rich_slides"),
        F.count_if("pasted").alias("pasted_slides"),
        F.sum("pictures").alias("pictures"),
        (F.sum("charts") + F.sum("diagrams") + F.count_if("animated")).alias("scarce"))

    def saturate(col: str, half: int) -> Column:
        return F.col(col) / (F.col(col) + F.lit(half))

    parts = {"rich_slides": saturate("rich_slides", 3),
             "usable_ratio": F.col("usable_slides") / F.col("slides"),
             "scarcity": saturate("scarce", 3),
             "media": saturate("pictures", 6)}
    penalties = {"mostly_pasted": F.col("pasted_slides") > F.col("slides") * 0.5,
                 "too_thin": F.col("usable_slides") < 3}
    raw = sum((F.lit(float(P.TRIAGE_WEIGHTS[k])) * v for k, v in parts.items()), F.lit(0.0))
    raw = raw - sum((F.when(v, F.lit(float(P.TRIAGE_PENALTIES[k]))).otherwise(0.0)
                     for k, v in penalties.items()), F.lit(0.0))
    score = F.bround(F.least(F.greatest(raw, F.lit(0.0)), F.lit(100.0)), 1)
    verdict = (F.when(score >= P.VERDICT_LINES[0][1], P.VERDICT_LINES[0][0])
               .when(score >= P.VERDICT_LINES[1][1], P.VERDICT_LINES[1][0])
               .otherwise("reject"))
    return (per_deck.withColumns({f"part_{k}": v for k, v in parts.items()})
            .withColumns({f"penalty_{k}": v for k, v in penalties.items()})
            .withColumn("score", score).withColumn("verdict", verdict))


def best_slides(flagged: DataFrame, k: int = 6) -> DataFrame:
    """The ``k`` richest usable slides of each deck; ties keep page order."""
    richness = (F.col("aligned_groups") * 3 + F.col("charts") * 3 + F.col("diagrams") * 3
                + F.col("tables") * 2 + F.col("pictures") + F.col("content") / 4)
    order = Window.partitionBy("deck").orderBy(F.desc("richness"), "slide")
    return (flagged.where("usable").withColumn("richness", richness)
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= k))


# ------------------------------------------------------------------ choosing

# Capability families and what each recorded capability is worth.
FAMILY_VALUE = {
    "animation": {"animation_effects": 1, "motion_paths": 4, "interactive_triggers": 3,
                  "transitions": 2},
    "equation": {"equations": 5},
    "chart": {"charts": 3},
    "effects": {"effects": 1},
}


def family_value(pool: DataFrame, families: Sequence[str] = tuple(FAMILY_VALUE)) -> DataFrame:
    """Unpivot to one row per (pool row, family) with the family's value."""
    values = F.array(*[
        F.struct(F.lit(i).alias("family_ord"), F.lit(name).alias("family"),
                 sum((F.coalesce(F.col(c), F.lit(0)) * w for c, w in FAMILY_VALUE[name].items()),
                     F.lit(0)).cast("long").alias("family_value"))
        for i, name in enumerate(families)])
    return pool.withColumn("__f", F.explode(values)).select("*", "__f.*").drop("__f")


def pool_key() -> Column:
    return F.coalesce(F.nullif("checksum", F.lit("")), F.col("filename"), F.lit(""))


def todo(kept: DataFrame, pool: DataFrame) -> DataFrame:
    """Kept rows nobody has scored yet."""
    seen = pool.select("pool_key").distinct()
    return kept.withColumn("pool_key", pool_key()).join(seen, "pool_key", "left_anti")


def stale_labels(pool: DataFrame, version: int = P.TRIAGE_VERSION, min_score: float = 50.0) -> DataFrame:
    """Selectable rows whose labels come from another triage version."""
    return pool.where((F.col("status") == "scored") & F.col("used_in").isNull()
                      & (F.coalesce("score", F.lit(0.0)) >= min_score)
                      & ~F.col("triage_version").eqNullSafe(F.lit(version)))


def candidates(pool: DataFrame, min_score: float = 50.0) -> DataFrame:
    return pool.where((F.col("status") == "scored") & (F.coalesce("used_in", F.lit("")) == "")
                      & (F.coalesce("score", F.lit(0.0)) >= min_score)
                      & (F.coalesce("fonts_missing", F.lit("")) == ""))


def choose(pool: DataFrame, n: int, min_score: float = 50.0) -> DataFrame:
    """The ``n`` best unused rows; score descending, key ascending."""
    return candidates(pool, min_score).orderBy(F.desc("score"), "pool_key").limit(n)


def family_shortlist(pool: DataFrame, n: int, families: Sequence[str],
                     min_score: float = 50.0) -> DataFrame:
    """Each family's own best ``n`` rows of positive value, with their place in that family.

    At most ``n - 1`` of a family's rows can go to other families, so nothing beyond its first ``n``
    can be needed.  The result has at most ``n * len(families)`` rows whatever the pool's size.
    """
    valued = family_value(candidates(pool, min_score), families).where(F.col("family_value") > 0)
    order = Window.partitionBy("family").orderBy(F.desc("family_value"), F.desc("score"),
                                                 "pool_key")
    return (valued.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n))


def choose_balanced(pool: DataFrame, n: int, families: Sequence[str],
                    min_score: float = 50.0) -> DataFrame:
    """Families take turns; each takes its best row that is still free.

    The shortlist is bounded, so the turn order is replayed over it as one ordered fold.
    """
    short = family_shortlist(pool, n, families, min_score)
    k = len(families)
    entry = F.struct("family_ord", "place", "pool_key")
    lists = short.agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    state = F.struct(F.array().cast("array<struct<pool_key:string,family_ord:int,turn:int>>").alias("picked"),
                     F.array().cast("array<string>").alias("used"))

    def step(acc: Column, turn: Column, rows: Column) -> Column:
        mine = F.filter(rows, lambda r: (r["family_ord"] == (turn % k))
                        & ~F.array_contains(acc["used"], r["pool_key"]))
        best = F.try_element_at(mine, F.lit(1))
        take = best.isNotNull() & (F.size(acc["picked"]) < n)
        return F.when(take, F.struct(
            F.array_append(acc["picked"], F.struct(
                best["pool_key"].alias("pool_key"), (turn % k).cast("int").alias("family_ord"),
                turn.cast("int").alias("turn"))).alias("picked"),
            F.array_append(acc["used"], best["pool_key"]).alias("used"))).otherwise(acc)

    turns = F.sequence(F.lit(0), F.lit(n * k - 1))
    folded = lists.select(F.aggregate(turns, state, lambda acc, t: step(acc, t, F.col("rows")))
                          .alias("s"))
    names = F.array(*[F.lit(f) for f in families])
    return (folded.select(F.posexplode("s.picked").alias("pos", "p"))
            .select(F.col("pos").cast("long").alias("pos"), "p.pool_key",
                    F.element_at(names, F.col("p.family_ord") + 1).alias("family")))


def parse_quotas(text: str, families: Sequence[str], n: int) -> dict[str, int]:
    """``chart=4,effects=2`` to a complete, valid distribution over ``families``."""
    quotas: dict[str, int] = {}
    for item in text.split(","):
        family, sep, count = (piece.strip() for piece in item.partition("="))
        if not sep or not count.lstrip("-").isdigit():
            raise ValueError(f"quota {item!r} is not family=count")
        if family not in families or family in quotas or int(count) < 0:
            raise ValueError(f"quota {item!r} is unknown, repeated or negative")
        quotas[family] = int(count)
    if set(quotas) != set(families) or sum(quotas.values()) != n:
        raise ValueError(f"quotas {quotas} do not cover {list(families)} with a total of {n}")
    return quotas


def choose_quota(pool: DataFrame, quotas: dict[str, int], min_score: float = 50.0) -> DataFrame:
    """A choice that fills every family's quota whenever one exists.

    Families name slots; a row may fill one slot.  The shortlist is at most ``n`` rows per family,
    and the assignment over it is one small grouped step in a Python worker.
    """
    import pandas as pd

    families, n = list(quotas), sum(quotas.values())
    short = family_shortlist(pool, n, families, min_score)

    def assign(pdf: "pd.DataFrame") -> "pd.DataFrame":
        wants = pdf.sort_values(["family_ord", "place"])
        choices = {f: g["pool_key"].tolist() for f, g in wants.groupby("family")}
        slots = [f for f in families for _ in range(quotas[f])]
        owner: dict[str, int] = {}
        for start in range(len(slots)):
            # breadth-first search for an alternating path from this slot to a free row
            came, queue, free = {}, [start], None
            while queue and free is None:
                slot = queue.pop(0)
                for key in choices.get(slots[slot], []):
                    if key in came:
                        continue
                    came[key] = slot
                    if key not in owner:
                        free = key
                        break
                    queue.append(owner[key])
            if free is None:
                continue
            back = {slot: key for key, slot in owner.items()}
            while free is not None:
                slot = came[free]
                previous = back.get(slot)
                owner[free] = slot
                free = previous if slot != start else None
        rows = [(key, slots[slot]) for key, slot in owner.items()]
        return pd.DataFrame(rows, columns=["pool_key", "family"])

    return (short.select("family", "family_ord", "place", "pool_key")
            .withColumn("batch", F.lit(0)).groupBy("batch").applyInPandas(assign, "pool_key string, family string"))


def vet_wave(ranked: DataFrame, need: int, spares: int) -> DataFrame:
    """Rows vetted in the first wave and the ``need`` of them that passed, in rank order."""
    wave = ranked.orderBy(F.desc("score"), "pool_key").limit(need + spares)
    order = Window.orderBy(F.desc("score"), "pool_key")          # need + spares rows
    passed = F.sum(F.coalesce("render_ok", F.lit(False)).cast("int")).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    return (wave.withColumn("passed_so_far", passed.cast("long"))
            .withColumn("chosen", F.coalesce("render_ok", F.lit(False))
                        & (F.col("passed_so_far") <= need)))


def vet_waves(ranked: DataFrame, need: int, spares: int) -> DataFrame:
    """Rows that are vetted, wave after wave until ``need`` of them have passed, with ``wave`` and ``chosen``.

    A wave takes as many rows in rank order as are still needed, and ``spares`` more; rows behind the last
    wave are not vetted.  Only the positions of the first ``need`` passes reach the driver.  Where the rows run
    out first, all are vetted and fewer are chosen.
    """
    placed = cut_lineage(ranked_rows(ranked, [F.desc("score"), F.col("pool_key")], "position")
                         .withColumn("__ok", F.coalesce("render_ok", F.lit(False))))
    total = placed.count()
    passes = [r["position"] for r in placed.where("__ok").orderBy("position").limit(need).select("position").collect()]
    waves, end, got = [], 0, 0
    while got < need and end < total:
        start, end = end, min(total, end + need - got + spares)
        got = bisect_left(passes, end)
        waves.append((len(waves) + 1, start, end - 1))
    last = passes[-1] if len(passes) == need else total
    spans = placed.sparkSession.createDataFrame(waves, "wave long, lo long, hi long")
    at = spans.select("wave", F.explode(F.sequence("lo", "hi")).alias("position"))
    return placed.join(at, "position").withColumn("chosen", F.col("__ok") & (F.col("position") <= last)).drop("__ok")


def stamp_used(pool: DataFrame, chosen: DataFrame, batch: str) -> DataFrame:
    """Write the batch name on the pool rows it used.  The chosen set is a bounded top-n."""
    marks = chosen.select("pool_key", F.lit(batch).alias("__batch"))
    return (pool.join(marks, "pool_key", "left")
            .withColumn("used_in", F.coalesce("__batch", "used_in")).drop("__batch"))


def manifest(chosen: DataFrame) -> DataFrame:
    return chosen.select("name", "filename", "license", "checksum", "sha256", "score")


def verify_bytes(pinned: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows whose bytes are absent or are not the pinned ones."""
    have = actual.select("name", F.sha2("content", 256).alias("actual"))
    return (pinned.join(have, "name", "left")
            .where(~F.col("actual").eqNullSafe(F.col("sha256")))
            .withColumn("problem", F.when(F.col("actual").isNull(), "missing")
                        .otherwise("bytes changed")))


def attach_provenance(decks: DataFrame, sources: DataFrame) -> DataFrame:
    """Join decks to their source rows by file name without the leading ordinal."""
    plain = F.regexp_replace(F.col("name"), "^[0-9]+-", "")
    joined = decks.withColumn("source_name", plain).join(
        sources.withColumnRenamed("filename", "source_name"), "source_name", "left")
    lacking = (F.coalesce("license", F.lit("")) == "") | (F.coalesce("url", F.lit("")) == "")
    return joined.withColumn("problem", F.when(lacking, "no licence or source recorded"))


def creators(records: DataFrame, cache: DataFrame) -> DataFrame:
    """Creator names by the record id inside a DOI; unknown records keep null."""
    rid = F.regexp_extract("doi", r"zenodo\.([0-9]+)", 1)
    return records.withColumn("record_id", rid).join(cache, "record_id", "left")


def render_verdict(pages: DataFrame) -> DataFrame:
    """Per deck: short, blank or ok from page statistics; nothing rendered is a failure."""
    per_deck = pages.groupBy("deck").agg(
        F.max("expect").alias("expect"), F.count("stddev").alias("rendered"),
        F.max("stddev").alias("strongest"))
    status = (F.when((F.col("expect").isNull()) | (F.col("expect") < 1), "failed")
              .when(F.col("rendered") != F.col("expect"), "short")
              .when(F.col("strongest") > P.BLANK_STDDEV, "ok").otherwise("blank"))
    return per_deck.withColumn("status", status).withColumn("ok", status == "ok")
