"""Stage state: progress, staleness, recovery, queues and yield.

``stage_state`` has at most one row per (deck, stage), eleven per deck, so per-deck windows and
lists here are bounded by the number of stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.ordered import exact_median
from gradeloom.operators.graph import reachable

# Stages in order, agent stages, statuses.
STAGES = ("ingested", "inspected", "proposed", "recipe", "degraded", "materialised",
          "reconciled", "solvable", "scored", "hardened", "packaged")
AGENT_STAGES = ("proposed", "recipe", "reconciled", "solvable")
PARKED = ("needs_human", "crashed", "failed", "infra")
MAX_REPAIRS = 3
CODE_INPUT = "<code>"
WITNESSED = ("proposed", "recipe", "reconciled", "solvable")
ADOPTABLE = ("proposed", "recipe", "reconciled")


def promotes(stage: Column, status: Column) -> Column:
    """A status that lets a run move past the stage; one stage may end partial."""
    return F.coalesce((status == "ok") | ((stage == "materialised") & (status == "partial")),
                      F.lit(False))


def own_inputs_moved(inputs: DataFrame) -> DataFrame:
    """(deck, stage): whether a fingerprint exists and whether a non-code input differs from it."""
    changed = ~F.col("digest_then").eqNullSafe(F.col("digest_now"))
    return inputs.groupBy("deck", "stage").agg(
        F.bool_or(F.col("digest_then").isNotNull()).alias("has_print"),
        F.bool_or(changed & (F.col("input") != CODE_INPUT)).alias("changed"))


def staleness(state: DataFrame, inputs: DataFrame) -> DataFrame:
    """Add ``stale``: own inputs moved, or an earlier stage moved or was refused.

    A stage without a fingerprint is never stale.  Because an earlier stage that is stale through a
    still earlier one is itself preceded by the cause, one pass over the preceding stages suffices.
    """
    rows = (state.join(own_inputs_moved(inputs), ["deck", "stage"], "left")
            .withColumn("has_print", F.coalesce("has_print", F.lit(False)))
            .withColumn("moved", F.col("has_print") & F.coalesce("changed", F.lit(False))))
    counted = F.col("status").isNotNull() & (F.col("status") != "skipped")
    passing = promotes(F.col("stage"), F.col("status"))
    blocks = counted & ((passing & F.col("moved")) | ~passing)
    before = (Window.partitionBy("deck").orderBy("stage_idx")
              .rowsBetween(Window.unboundedPreceding, -1))
    upstream = F.coalesce(F.max(blocks.cast("int")).over(before), F.lit(0)) == 1
    return (rows.withColumn("upstream", upstream)
            .withColumn("stale", F.col("has_print") & (F.col("moved") | F.col("upstream")))
            .drop("changed"))


def effective_status(state: DataFrame) -> DataFrame:
    """Recorded status, downgraded to ``stale`` where a passing one no longer holds."""
    down = F.col("status").isin("ok", "partial") & F.col("stale")
    return state.withColumn("effective", F.when(down, "stale").otherwise(F.col("status")))


def _first_gap(passed: Column) -> Column:
    """Index of the first stage, in order, that is not in the set ``passed``."""
    every = F.sequence(F.lit(0), F.lit(len(STAGES) - 1)).cast("array<bigint>")
    return F.coalesce(F.try_element_at(
        F.filter(every, lambda i: ~F.array_contains(passed, i)), F.lit(1)), F.lit(len(STAGES)))


def furthest(state: DataFrame, status: str = "status") -> DataFrame:
    """(deck, reached_idx, reached): the last stage before the first gap; -1 when nothing passed."""
    ok = promotes(F.col("stage"), F.col(status))
    names = F.array(*[F.lit(s) for s in STAGES])
    per = state.groupBy("deck").agg(F.collect_set(F.when(ok, F.col("stage_idx"))).alias("passed"))
    reached = (_first_gap(F.col("passed")) - 1).cast("long")
    return per.select("deck", reached.alias("reached_idx"), F.coalesce(
        F.get(names, reached.cast("int")), F.lit("—")).alias("reached"))


def code_drift(state: DataFrame, inputs: DataFrame) -> DataFrame:
    """Passing stages whose recorded code digest is not the current one; advisory only."""
    drifted = inputs.where((F.col("input") == CODE_INPUT) & F.col("digest_then").isNotNull()
                           & (F.col("digest_then") != F.col("digest_now")))
    return drifted.select("deck", "stage").join(
        state.where(F.col("status") == "ok").select("deck", "stage"), ["deck", "stage"])


def recover_archived(state: DataFrame, attempts: DataFrame, current: DataFrame) -> DataFrame:
    """Newest archived success of an unpromoted agent stage whose inputs equal the current ones.

    ``attempts(deck, stage, attempt, status, inputs)`` and ``current(deck, stage, inputs)`` carry
    inputs as sorted text, so equality is one comparison inside the join.
    """
    open_stages = state.where(F.col("stage").isin(*AGENT_STAGES)
                              & ~promotes(F.col("stage"), F.col("status"))).select("deck", "stage")
    usable = (attempts.where(promotes(F.col("stage"), F.col("status")))
              .join(current, ["deck", "stage", "inputs"])
              .join(open_stages, ["deck", "stage"]))
    return usable.groupBy("deck", "stage").agg(F.max("attempt").alias("attempt"))


def module_closure(imports: DataFrame, seeds: DataFrame, leaves: DataFrame,
                   excluded: DataFrame) -> DataFrame:
    """Per stage, the modules it depends on; leaves count but are not followed, excluded are dropped."""
    clean = (imports.join(excluded.withColumnRenamed("node", "child"), "child", "left_anti")
             .join(excluded.withColumnRenamed("node", "parent"), "parent", "left_anti"))
    return reachable(clean, seeds, stop_at=leaves)


def closure_digest(closure: DataFrame, sources: DataFrame) -> DataFrame:
    """One digest per root over (module, content digest) pairs, in module order.

    A closure is the module list of one code base, which bounds the list.
    """
    parts = closure.join(sources, "node").groupBy("root").agg(
        F.array_sort(F.collect_list(F.concat_ws(":", F.col("node"), F.col("digest")))).alias("p"))
    return parts.select("root", F.size("p").cast("long").alias("modules"),
                        F.sha1(F.concat_ws("\n", "p")).alias("digest"))


def given_up(state: DataFrame, decks: DataFrame) -> DataFrame:
    """Why a deck will not move again: a parked status, or a refusal with no repairs left.

    ``decks(deck, repairs, running)``.
    """
    parked = F.min(F.when(F.col("status").isin(*PARKED), F.struct("stage_idx", "stage", "status")))
    refused = F.min(F.when(F.col("status") == "rejected", F.struct("stage_idx", "stage", "status")))
    per = state.groupBy("deck").agg(parked.alias("p"), refused.alias("r")).join(decks, "deck")
    spent = ~F.col("running") & (F.col("repairs") >= MAX_REPAIRS)
    return (per.withColumn("why", F.when(F.col("p").isNotNull(), "status")
                           .when(spent & F.col("r").isNotNull(), "repair budget spent"))
            .where(F.col("why").isNotNull())
            .select("deck", F.when(F.col("why") == "status", F.col("p.stage")).otherwise(F.col("r.stage")).alias("stage"),
                    F.when(F.col("why") == "status", F.col("p.status")).otherwise(F.col("r.status")).alias("status"), "why"))


def pool_of(stage: Column) -> Column:
    return F.when(stage.isin(*AGENT_STAGES, "repair"), "agent").when(stage.isNotNull(), "cpu")


def queue_view(state: DataFrame, decks: DataFrame) -> DataFrame:
    """done_through, next stage, pool, and whether the deck waits in a queue."""
    names = F.array(*[F.lit(s) for s in STAGES])
    stopped = given_up(state, decks).select("deck", F.lit(True).alias("__stopped"))
    rows = furthest(state).join(decks, "deck").join(stopped, "deck", "left")
    following = F.get(names, (F.col("reached_idx") + 1).cast("int"))
    return (rows.withColumn("next", following).withColumn("finished", following.isNull())
            .withColumn("pool", pool_of(following))
            .withColumn("parked", F.coalesce("__stopped", F.lit(False)))
            .withColumn("queued", following.isNotNull() & ~F.col("running") & ~F.col("parked"))
            .select("deck", F.col("reached").alias("done_through"), "next", "finished", "pool",
                    "parked", "queued"))


def yield_counts(state: DataFrame) -> DataFrame:
    """(outcome, n): packaged decks, and ``last -> status`` of the others."""
    reach = furthest(state)
    after = state.select("deck", F.col("stage_idx").alias("__i"), "status")
    joined = reach.join(after, (reach["deck"] == after["deck"])
                        & (F.col("__i") == F.col("reached_idx") + 1), "left")
    outcome = F.when(F.col("reached_idx") == len(STAGES) - 1, "packaged").otherwise(
        F.concat("reached", F.lit(" -> "), F.coalesce("status", F.lit("not started"))))
    return joined.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def stage_durations(state: DataFrame) -> DataFrame:
    """Recorded milliseconds, else the gap to the previous stamp of the deck; negatives dropped."""
    before = (Window.partitionBy("deck").orderBy("stage_idx")
              .rowsBetween(Window.unboundedPreceding, -1))
    previous = F.last("at_ms", ignorenulls=True).over(before)
    gap = F.floor((F.col("at_ms") - previous)).cast("long")
    return (state.withColumn("derived", F.col("duration_ms").isNull() & gap.isNotNull())
            .withColumn("ms", F.coalesce("duration_ms", gap))
            .where(F.col("ms").isNotNull() & (F.col("ms") >= 0)))


def duration_summary(durations: DataFrame, width: float = 1000.0) -> DataFrame:
    totals = durations.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms").alias("total_ms"),
        F.count_if("derived").alias("derived"), F.max("ms").alias("max_ms"))
    middle = exact_median(durations, ["stage"], "ms", width, "__m")
    return totals.join(middle, "stage").withColumn("median_ms", F.floor("__m").cast("long")).drop("__m")


def status_lists(state: DataFrame, bundles: DataFrame) -> DataFrame:
    """Per deck: a gate said no, passed with nothing to hand over, parked, API attempts needed."""
    per = state.groupBy("deck").agg(
        F.bool_or(F.col("status") == "rejected").alias("__rejected"),
        F.bool_or((F.col("stage") == STAGES[-1]) & (F.col("status") == "ok")).alias("__done"),
        F.bool_or((F.col("stage") == "solvable") & (F.col("status") == "ok")).alias("__solvable"),
        F.bool_or(F.col("status").isin("needs_human", "crashed")).alias("parked"),
        F.max("attempts").alias("__attempts"))
    return (per.join(bundles, "deck", "left")
            .select("deck", (F.col("__rejected") & ~F.col("__done")).alias("sent_back"),
                    (F.col("__solvable") & ~F.coalesce("has_bundle", F.lit(False))).alias("naked"),
                    "parked", F.when(F.col("__attempts") > 1, F.col("__attempts")).otherwise(0)
                    .cast("long").alias("api_attempts")))


def models_used(state: DataFrame) -> DataFrame:
    label = F.concat(F.coalesce("model", F.lit("unrecorded")),
                     F.when(F.col("fallback"), F.lit(" (fallback)")).otherwise(F.lit("")))
    return state.groupBy("stage", label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def shipped(records: DataFrame) -> DataFrame:
    """Whether the record says a deck produced a task, and the first reason it does not."""
    why = (F.when(~F.col("packaged").eqNullSafe(F.lit("ok")), "packaged is not ok")
           .when(~F.col("has_review"), "no review")
           .when(~F.col("gt_score").eqNullSafe(F.lit(1.0)) | ~F.col("input_score").eqNullSafe(F.lit(0.0)),
                 "scores are not 1 and 0")
           .when(F.col("bundle_gaps") > 0, "bundle has gaps"))
    return records.withColumn("why", why).withColumn("shipped", why.isNull())


def unwitnessed(state: DataFrame) -> DataFrame:
    """First stage per deck recorded ok with no run behind it and no allowed adoption."""
    suspect = state.where(F.col("stage").isin(*WITNESSED) & (F.col("status") == "ok")
                          & ~(F.col("stage").isin(*ADOPTABLE) & F.col("adopted"))
                          & ~F.col("has_run"))
    return suspect.groupBy("deck").agg(F.min_by("stage", "stage_idx").alias("stage"))


def still_to_run(decks: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """Decks not booked as shipped; with a request list, absent ids come back as findings."""
    if requested is None:
        return decks.where(~(F.col("shipped") & F.col("outcome").eqNullSafe(F.lit("shipped")))).select(
            "deck", F.lit(None).cast("string").alias("problem"))
    have = decks.select("deck", F.lit(True).alias("__have"))
    return requested.join(have, "deck", "left").select(
        "deck", F.when(F.col("__have").isNull(), "requested deck is absent").alias("problem"))
