"""Run-log and timeline analytics.

Events carry ``day`` (a block of time) besides their order, so that a deck or a run with a very long
history is windowed block by block (see ``functions.ordered``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.ordered import (exact_median, first_per_key, last_per_key, running_sum,
                                         with_next, with_previous)
from gradeloom.functions.text import rule_case
from gradeloom.operators.defects import normalise
from gradeloom.operators.state import AGENT_STAGES, PARKED

# Thresholds.
NOTABLE = ("rejected", "failed", "infra", "needs_human", "crashed")
NOTABLE_MAX = 40
MIN_WALL_S = 5.0
IMPOSSIBLE_USE = 1.05
STALL_AFTER_S = 300.0
LOG_AGE_SLACK_S = 1.0
STALL_MINUTES = 25
LOOP_REPEATS = 2
MEM_FREE_FRAC = 0.15
ALERT_CONFIRM = 2
LIMIT_RANK = {"flag": 3, "run-argv": 2}
SETTLED = ("packaged", "parked", "escalated", "failed")

# How a log line is read; first match wins, in this order.
LINE_KINDS = [
    ("packaged", r"consistency=ok"),
    ("escalated", r"\bESCALATED\b"),
    ("parked", r"\bPARKED\b"),
    ("crashed", r"\bCRASHED\b"),
    ("infra", r"\bINFRA\b|429|session limit|Too Many Requests"),
    ("failed", r"\bFAILED\b"),
    ("rejected", r"\bREJECTED\b"),
    ("no_op_repair", r"repair CHANGED NOTHING"),
    ("blocked", r"\bBUSY\b"),
    ("truncated", r"\bTRUNCATED\b"),
    ("repairing", r"\brepaired \(attempt"),
    ("skipped", r"^skipped —"),
]
DECK_LINE = r"^\s{2}[·~]?\s*(deck\d+)\s\s+(.*?)\s*$"
PHASE_LINE = r"^###\s+(.*?)\s+\[(\d\d:\d\d:\d\d)\]\s*$"
SUMMARY_MARKERS = ("stages: 1·ingested", "### where it got to")


# ------------------------------------------------------------------ event pairing

def stage_runs(events: DataFrame) -> DataFrame:
    """One row per finished stage, with its own milliseconds or the gap to its start; plus open starts.

    A finish closes the newest start since the previous finish of the same (deck, stage), which is
    the event just before it when only starts and finishes are looked at.
    """
    marks = events.where(F.col("event").isin("stage_started", "stage_finished"))
    seen = with_previous(marks, ["deck", "stage"], "day", ["us", "ord"],
                         F.struct("event", "ts"), "before")
    began = F.when(F.col("before.event") == "stage_started", F.col("before.ts"))
    gap = F.floor((F.col("ts") - F.col("began")) * 1000).cast("long")
    done = (seen.where(F.col("event") == "stage_finished").withColumn("began", began)
            .withColumn("ms", F.coalesce("ms", gap, F.lit(0)))
            .select("deck", "stage", "status", "ms", "began", "ts", "ord"))
    last = last_per_key(marks, ["deck", "stage"], ["us", "ord"], ["event", "ts", "ord"])
    still = last.where(F.col("event") == "stage_started").select(
        "deck", "stage", F.lit("running").alias("status"), F.lit(0).cast("long").alias("ms"),
        F.col("ts").alias("began"), F.lit(None).cast("double").alias("ts"), "ord")
    return done.unionByName(still)


def run_span(events: DataFrame) -> DataFrame:
    """First and last stamp, the last status record, and whether the run ended."""
    return events.agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        (F.max("ts") - F.min("ts")).alias("seconds"),
        F.max_by("event", F.struct("us", "ord")).alias("last_event"),
        F.bool_or(F.col("event") == "run_finished").alias("ended"))


def stage_clock(runs: DataFrame, width: float = 1000.0) -> DataFrame:
    timed = runs.where(F.col("ms") > 0)
    totals = timed.groupBy("stage").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("ms").alias("busy_ms"), F.max("ms").alias("longest_ms"),
        F.min_by("deck", F.struct(-F.col("ms"), "ord")).alias("longest_deck"))
    return totals.join(exact_median(timed, ["stage"], "ms", width, "median_ms"), "stage")


def pool_use(runs: DataFrame, span: DataFrame, slots: dict[str, int | None]) -> DataFrame:
    """Busy time over wall clock times slots; withheld when the span is short or slots unknown."""
    known = F.create_map(*[x for k, v in slots.items() for x in (F.lit(k), F.lit(v).cast("int"))])
    busy = (runs.where(F.col("ms") > 0)
            .groupBy(F.when(F.col("stage").isin(*AGENT_STAGES), "agent").otherwise("cpu").alias("pool"))
            .agg(F.sum("ms").alias("busy_ms")))
    rows = busy.join(F.broadcast(span.select("seconds")), how="cross")      # span is one row
    use = F.when((F.col("seconds") >= MIN_WALL_S) & F.col("slots").isNotNull(),
                 F.col("busy_ms") / 1000 / (F.col("seconds") * F.col("slots")))
    return (rows.withColumn("slots", F.try_element_at(known, F.col("pool")))
            .withColumn("used", use).withColumn("impossible", F.col("used") > IMPOSSIBLE_USE))


def deck_endings(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Per deck: stages run, skips, busy time, and how it ended.  Open stages count as the latest."""
    per = runs.groupBy("deck").agg(
        F.count(F.lit(1)).alias("stages"), F.sum("ms").alias("busy_ms"),
        F.max_by(F.struct("stage", "status"), F.struct((F.col("status") == "running").cast("int"), "ord")).alias("last"))
    skips = events.where(F.col("event") == "stage_skipped").groupBy("deck").agg(
        F.count(F.lit(1)).alias("skipped"))
    ending = F.coalesce(F.concat_ws(" ", "last.stage", "last.status"), F.lit("nothing to do"))
    return (per.join(skips, "deck", "full").select(
        "deck", F.coalesce("stages", F.lit(0)).alias("stages"),
        F.coalesce("skipped", F.lit(0)).alias("skipped"),
        F.coalesce("busy_ms", F.lit(0)).alias("busy_ms"),
        F.when(F.col("last").isNull(), "nothing to do").otherwise(ending).alias("ending")))


def notable(events: DataFrame) -> DataFrame:
    """Retries and bad endings with their first non-empty reason."""
    retried = F.col("event") == "stage_retried"
    bad = (F.col("event") == "stage_finished") & F.col("status").isin(*NOTABLE)
    what = F.when(retried, F.concat(F.lit("retried after "), F.coalesce("retry_kind", F.lit("?"))))
    return events.where(retried | bad).select(
        "ord", "us", "deck", "stage", F.coalesce(what, F.col("status")).alias("what"),
        F.nullif("why", F.lit("")).alias("why"))


def notable_report(events: DataFrame, cap: int = NOTABLE_MAX) -> DataFrame:
    """The first ``cap`` notable events in order and, as one more row, how many there are beyond."""
    rows = notable(events)
    first = rows.orderBy("us", "ord").limit(cap).withColumn("more", F.lit(None).cast("long"))
    rest = rows.agg((F.count(F.lit(1)) - cap).alias("more")).where(F.col("more") > 0)
    return first.unionByName(rest, allowMissingColumns=True).drop("us")


def skip_tally(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event") == "stage_skipped").groupBy("stage", "why")
            .agg(F.count(F.lit(1)).alias("n")))


def at_moment(events: DataFrame, until_us: Column) -> DataFrame:
    """Who was in which stage at a time: the deck's newest mark up to then is a start."""
    marks = events.where(F.col("event").isin("stage_started", "stage_finished")
                         & (F.col("us") <= until_us))
    last = last_per_key(marks, ["deck"], ["us", "ord"], ["event", "stage", "ts"])
    return last.where(F.col("event") == "stage_started").select("deck", "stage", F.col("ts").alias("since"))


# ------------------------------------------------------------------ sessions

def distinct_sessions(sessions: DataFrame) -> DataFrame:
    """First copy by path of every session; a session without an id is its own path."""
    key = F.coalesce("session_id", "path")
    cols = [c for c in sessions.columns if c != "path"]
    return first_per_key(sessions.withColumn("__sid", key), ["__sid"], ["path", "turns", "output"], cols).drop("__sid")


def session_totals(sessions: DataFrame, by: Sequence[str]) -> DataFrame:
    return sessions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("output").alias("output"),
        F.sum("input").alias("input"), F.bround(F.sum("cost_usd"), 4).alias("cost_usd"),
        F.sum("turns").alias("turns"), F.sum("wall_ms").alias("wall_ms"),
        F.count_if("is_error").alias("errors"))


def session_outcome(results: DataFrame) -> DataFrame:
    """infra, truncated or finished from the last result record; a 403 is an auth error."""
    why = F.col("terminal_reason")
    status = (F.when(why.isin("aborted_streaming", "api_error", "auth_error"), "infra")
              .when(why.isin("max_turns", "max_tokens", "refusal"), "truncated").otherwise("finished"))
    kind = (F.when(why == "aborted_streaming", why)
            .when((why == "auth_error") | ((why == "api_error") & (F.col("api_status") == 403)), "auth_error")
            .when(status != "finished", why))
    return results.withColumn("status", status).withColumn("kind", kind)


def model_that_worked(usage: DataFrame, openings: DataFrame) -> DataFrame:
    """Model with most output tokens per session against the one the session opened with."""
    ran = usage.groupBy("session_id").agg(
        F.min_by("model", F.struct(-F.col("tokens"), "model_ord")).alias("model_ran"))
    return (openings.join(ran, "session_id", "left")
            .withColumn("fallback", F.coalesce(F.col("model_ran") != F.col("model_session"), F.lit(False))))


# Tools that read, and path tails a probe may touch.
READING_TOOLS = ("Read", "Bash", "Grep", "Glob", "NotebookRead")
ALLOWED_TAILS = ("/bundle", "/solvability.json")


def access_audit(calls: DataFrame, roots: Sequence[str]) -> DataFrame:
    """Reading tool calls whose arguments reach into a forbidden root outside the allowed tails."""
    alternatives = "|".join(r.replace(".", r"\.") for r in roots)
    hits = F.regexp_extract_all("args", F.lit(rf"((?:{alternatives})(?:/[^\s\"']*)?)"), F.lit(1))
    rows = (calls.where(F.col("tool").isin(*READING_TOOLS))
            .withColumn("hit", F.explode(hits))
            .withColumn("tail", F.regexp_replace("hit", f"^(?:{alternatives})", "")))
    exempt = F.lit(False)
    for tail in ALLOWED_TAILS:
        exempt = exempt | F.col("tail").startswith(tail)
    return rows.where(~exempt).groupBy("session_id", "tool", "hit").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ timeline

def _as_one_run(samples: DataFrame) -> DataFrame:
    return samples.withColumn("__run", F.lit(1))


def sample_spans(samples: DataFrame, width: float = 60.0) -> DataFrame:
    """Seconds each sample stands for: the gap to the next one, and the median gap for the last."""
    rows = with_next(_as_one_run(samples), ["__run"], "day", ["seq"], F.col("t"), "__next_t")
    gaps = rows.withColumn("__gap", F.col("__next_t") - F.col("t"))
    middle = exact_median(gaps, ["__run"], "__gap", width, "__mid").select("__mid")     # one row
    filled = gaps.join(F.broadcast(middle), how="left", on=F.lit(True))
    return (filled.withColumn("span", F.coalesce("__gap", "__mid", F.lit(0.0)))
            .drop("__run", "__next_t", "__gap", "__mid"))


def resolve_limits(samples: DataFrame, pools: Sequence[str] = ("agent", "cpu")) -> DataFrame:
    """Best-evidenced limit per pool; two values inside the best rank leave it unknown."""
    rank = F.lit(0)
    for source, value in LIMIT_RANK.items():
        rank = F.when(F.col("p.source") == source, value).otherwise(rank)
    said = (samples.select(F.explode(F.array(*[
        F.struct(F.lit(p).alias("pool"), F.col(f"{p}_limit").cast("long").alias("limit"),
                 F.col(f"{p}_source").alias("source")) for p in pools])).alias("p"))
        .where(F.col("p.limit").isNotNull()).withColumn("rank", rank).where(F.col("rank") > 0)
        .select("p.*", "rank").distinct())
    per = said.groupBy("pool", "rank").agg(F.countDistinct("limit").alias("values"),
                                           F.max("limit").alias("limit"), F.max("source").alias("source"))
    best = last_per_key(per, ["pool"], ["rank"], ["values", "limit", "source"])
    every = samples.sparkSession.createDataFrame([(p,) for p in pools], "pool string")
    return every.join(best, "pool", "left").select(
        "pool", F.when(F.col("values") == 1, F.col("limit")).alias("limit"),
        F.when(F.col("values").isNull(), "unknown").when(F.col("values") > 1, "conflicting")
        .otherwise(F.col("source")).alias("source"))


def pool_stats(spans: DataFrame, decks: DataFrame) -> DataFrame:
    """Time-weighted occupancy per pool; a limit below the measured peak is discarded."""
    load = decks.groupBy("seq", "pool").agg(F.count_if("running").alias("running"),
                                            F.count_if("queued").alias("queued"))
    limits = resolve_limits(spans)
    grid = spans.select("seq", "t", "span").join(F.broadcast(limits), how="cross")   # two pools
    rows = grid.join(load, ["seq", "pool"], "left").fillna(0, ["running", "queued"])
    at = F.col("running") >= F.col("limit")
    per = rows.groupBy("pool").agg(
        F.max("limit").alias("limit"), F.max("source").alias("source"),
        F.max("running").alias("peak"), F.max("queued").alias("peak_queue"),
        F.sum("span").alias("wall"), F.sum(F.col("running") * F.col("span")).alias("busy"),
        F.sum(F.col("queued") * F.col("span")).alias("queue_deck_seconds"),
        F.sum(F.when(at, F.col("span")).otherwise(0.0)).alias("at_limit"))
    broken = F.col("limit").isNotNull() & (F.col("peak") > F.col("limit"))
    kept = F.when(~broken, F.col("limit"))
    return per.select(
        "pool", "peak", "peak_queue", kept.alias("limit"),
        F.when(broken, "contradicted").otherwise(F.col("source")).alias("limit_source"),
        F.bround(F.col("busy") / F.col("wall"), 2).alias("mean"),
        F.bround(F.col("busy") / (F.col("wall") * kept), 3).alias("utilisation"),
        F.when(kept.isNotNull(), F.bround("at_limit", 1)).alias("seconds_at_limit"),
        F.bround("queue_deck_seconds", 1).alias("queue_deck_seconds"))


def claimed_silence(why: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(why, F.lit(r"no log output for ([0-9.]+)s"), F.lit(1)),
                            F.lit(1)).try_cast("double")


def impossible_stall(why: Column, since: Column) -> Column:
    """A silence longer than the stage has existed is an observer reading the wrong log."""
    return F.coalesce(claimed_silence(why) > since + LOG_AGE_SLACK_S, F.lit(False))


def deck_seconds(spans: DataFrame, decks: DataFrame) -> DataFrame:
    """Working, waiting, idle and stalled seconds per deck, and its elapsed time."""
    rows = decks.join(spans.select("seq", "span"), "seq")
    start = spans.agg(F.min("t").alias("__t0"))                              # one row
    stalled = F.col("hung_why").isNotNull() & ~impossible_stall(F.col("hung_why"), F.col("since_s"))
    working, waiting = F.col("running"), ~F.col("running") & F.col("queued")
    per = rows.groupBy("deck").agg(
        F.sum(F.when(working, F.col("span")).otherwise(0.0)).alias("working_s"),
        F.sum(F.when(waiting, F.col("span")).otherwise(0.0)).alias("waiting_s"),
        F.sum(F.when(~working & ~waiting, F.col("span")).otherwise(0.0)).alias("idle_s"),
        F.sum(F.when(stalled, F.col("span")).otherwise(0.0)).alias("stalled_s"),
        F.min(F.when(F.col("finished"), F.col("t"))).alias("__fin"),
        F.max_by(F.col("t") + F.col("span"), "seq").alias("__last"))
    return (per.join(F.broadcast(start), how="cross")
            .withColumn("elapsed_s", F.bround(F.coalesce("__fin", "__last") - F.col("__t0"), 1))
            .drop("__fin", "__last", "__t0"))


def stage_seconds(spans: DataFrame, decks: DataFrame, width: float = 600.0) -> DataFrame:
    """Per stage: decks, total, median and longest working seconds, waiting seconds."""
    rows = decks.join(spans.select("seq", "span"), "seq")
    work = rows.where("running").groupBy("stage", "deck").agg(F.sum("span").alias("s"))
    wait = rows.where(~F.col("running") & F.col("queued")).groupBy("stage").agg(F.sum("span").alias("wait_s"))
    total = work.groupBy("stage").agg(F.count(F.lit(1)).alias("decks"), F.sum("s").alias("total_s"),
                                      F.max("s").alias("max_s"))
    return (total.join(exact_median(work, ["stage"], "s", width, "median_s"), "stage", "full")
            .join(wait, "stage", "full").fillna(0))


def memory_report(samples: DataFrame) -> DataFrame:
    return samples.agg(
        F.max("rss_total").alias("peak_rss"), F.floor(F.avg("rss_total")).cast("long").alias("mean_rss"),
        F.min_by("largest_name", F.struct(-F.col("largest_rss"), "seq")).alias("largest_name"),
        F.max("largest_rss").alias("largest_rss"), F.min("avail").alias("min_avail"),
        F.min_by("seq", F.struct("avail", "seq")).alias("min_avail_seq"),
        F.max("displays_held").alias("peak_displays"), F.bool_or("saturated").alias("ever_saturated"))


def stall_report(decks: DataFrame) -> DataFrame:
    """Hung records split into real stalls and observer-blind ones, per deck."""
    rows = decks.where(F.col("hung_why").isNotNull()).withColumn(
        "verdict", F.when(impossible_stall(F.col("hung_why"), F.col("since_s")), "blind").otherwise("hung"))
    return rows.groupBy("deck", "verdict").agg(F.min("seq").alias("first_seq"),
                                               F.count(F.lit(1)).alias("samples"),
                                               F.min_by("hung_why", "seq").alias("why"))


def warning_counts(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("warn").isNotNull()).groupBy("warn").agg(F.count(F.lit(1)).alias("n"))


def transitions(samples: DataFrame, decks: DataFrame) -> DataFrame:
    """What changed for each deck since the sample before: appeared, finished, moved, parked."""
    prior = with_previous(_as_one_run(samples.select("seq", "day")), ["__run"], "day", ["seq"],
                          F.col("seq"), "prev_seq").where(F.col("prev_seq").isNotNull())
    was = decks.select(F.col("seq").alias("prev_seq"), "deck", F.col("stage").alias("was_stage"),
                       F.col("stage_idx").alias("was_idx"), F.col("running").alias("was_running"),
                       F.col("parked_status").alias("was_parked"))
    both = decks.join(prior.select("seq", "prev_seq"), "seq").join(was, ["prev_seq", "deck"], "left")
    known = F.col("was_stage").isNotNull()
    moved = (F.col("was_stage") != F.col("stage")) | (F.col("was_running") != F.col("running"))
    kinds = F.array(
        F.when(~known, "appeared"),
        F.when(known & (F.col("stage_idx") > F.col("was_idx")), "finished"),
        F.when(known & moved, F.when(F.col("running"), "started").otherwise("left")),
        F.when(known & F.col("parked_status").isNotNull() & F.col("was_parked").isNull(), "parked"))
    return both.select("seq", "deck", "stage", F.explode(F.array_compact(kinds)).alias("change"))


def alert_conditions(samples: DataFrame, decks: DataFrame, mem_free: float = MEM_FREE_FRAC) -> DataFrame:
    """Everything true of a sample somebody would want to know: (seq, key, kind, confirm)."""
    unfinished = decks.where(~F.col("finished") & F.col("parked_status").isNull())
    hung = decks.where(F.col("hung_why").isNotNull()).select(
        "seq", F.when(F.contains("hung_why", F.lit("dead pid")), "dead-lock").otherwise("stall").alias("kind"),
        F.col("deck").alias("id"), F.lit(ALERT_CONFIRM).alias("confirm"))
    parked = decks.where(F.col("parked_status").isin(*PARKED)).select(
        "seq", F.when(F.col("parked_status") == "crashed", "crash")
        .when(F.col("parked_status") == "infra", "infra").otherwise("park").alias("kind"),
        F.concat_ws("/", "deck", "stage").alias("id"), F.lit(1).alias("confirm"))
    memory = samples.where(F.col("avail") < F.col("total") * mem_free).select(
        "seq", F.lit("memory").alias("kind"), F.lit("").alias("id"), F.lit(ALERT_CONFIRM).alias("confirm"))
    displays = samples.where("saturated").select(
        "seq", F.lit("displays").alias("kind"), F.lit("").alias("id"), F.lit(ALERT_CONFIRM).alias("confirm"))
    gone = (samples.where(~F.col("has_roots")).join(unfinished.select("seq"), "seq", "left_semi")
            .select("seq", F.lit("run-gone").alias("kind"), F.lit("").alias("id"),
                    F.lit(ALERT_CONFIRM).alias("confirm")))
    return hung.unionByName(parked).unionByName(memory).unionByName(displays).unionByName(gone)


def edge_alerts(samples: DataFrame, conditions: DataFrame) -> DataFrame:
    """Each condition fires once, when it has held for ``confirm`` samples in a row.

    Samples are numbered; a condition's run starts where its previous sample is not the one just
    before; the alert is the row at which the run's length equals ``confirm``.
    """
    numbered = running_sum(_as_one_run(samples.select("seq", "day")), ["__run"], "day", ["seq"],
                           F.lit(1), "nth").drop("__run")
    held = conditions.join(numbered, "seq")
    keys = ["kind", "id"]
    before = with_previous(held, keys, "day", ["nth"], F.col("nth"), "before")
    starts = before.withColumn("start", F.when(
        F.col("before").isNull() | (F.col("before") != F.col("nth") - 1), F.col("nth")))
    spread = with_previous(starts, keys, "day", ["nth"], F.col("start"), "open")
    length = F.col("nth") - F.coalesce("start", "open") + 1
    return spread.where(length == F.col("confirm")).select("seq", "kind", "id")


def liveness(locks: DataFrame) -> DataFrame:
    """hung, blind or stalled per running stage; null when it is fine."""
    watched = F.col("running") & F.col("stage").isin(*AGENT_STAGES, "repair")
    verdict = (F.when(F.col("lock_alive") == F.lit(False), "hung")
               .when(~watched, F.lit(None))
               .when(F.col("log_age_s") > F.col("since_s") + LOG_AGE_SLACK_S, "blind")
               .when(F.col("log_age_s").isNull() & (F.coalesce("since_s", F.lit(0.0)) > STALL_AFTER_S), "blind")
               .when(F.coalesce("log_age_s", F.lit(0.0)) > STALL_AFTER_S, "stalled"))
    return locks.withColumn("verdict", verdict)


# ------------------------------------------------------------------ log supervision

def deck_lines(lines: DataFrame) -> DataFrame:
    """Deck lines of each log before its first summary marker, as (log_id, line_no, deck, message)."""
    marker = F.lit(False)
    for text in SUMMARY_MARKERS:
        marker = marker | F.contains("line", F.lit(text))
    cuts = lines.where(marker).groupBy("log_id").agg(F.min("line_no").alias("__cut"))
    kept = (lines.join(cuts, "log_id", "left")
            .where(F.col("__cut").isNull() | (F.col("line_no") < F.col("__cut"))).drop("__cut"))
    return (kept.where(F.col("line").rlike(DECK_LINE))
            .withColumn("deck", F.regexp_extract("line", DECK_LINE, 1))
            .withColumn("message", F.regexp_extract("line", DECK_LINE, 2)))


def phase_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("line").rlike(PHASE_LINE)).select(
        "log_id", "line_no", F.regexp_extract("line", PHASE_LINE, 1).alias("phase"),
        F.regexp_extract("line", PHASE_LINE, 2).alias("at"))


def line_kind(message: Column) -> Column:
    return rule_case(message, LINE_KINDS, "progress")


def complaint_key(message: Column) -> Column:
    """A complaint without the numbers and hashes that make each occurrence unique."""
    out = F.lower(message)
    # What is stripped, in this order.
    for pattern, stand_in in ((r"\b[0-9a-f]{8,}\b", "<hash>"), (r"\b\d+\.\d+\b", "<num>"),
                              (r"\b\d+\b", "<n>"), (r"\s+", " ")):
        out = F.regexp_replace(out, pattern, stand_in)
    return F.trim(out)


def fold_lines(lines: DataFrame) -> DataFrame:
    """Per deck: last kind and message, when it was last seen, how many lines."""
    return lines.groupBy("deck").agg(
        F.max_by(F.struct(line_kind(F.col("message")).alias("kind"), F.col("message").alias("last")), "line_no").alias("s"),
        F.max("us").alias("last_us"), F.count(F.lit(1)).alias("lines")).select("deck", "s.*", "last_us", "lines")


def complaints(lines: DataFrame) -> DataFrame:
    bad = lines.where(line_kind(F.col("message")).isin("rejected", "no_op_repair"))
    return bad.groupBy("deck", complaint_key(F.col("message")).alias("complaint")).agg(
        F.count(F.lit(1)).alias("n"))


def shared_causes(states: DataFrame) -> DataFrame:
    """(cause, deck, decks): decks whose last message, normalised, is shared by two or more."""
    rows = (states.where(F.col("kind").isin("failed", "rejected", "parked"))
            .select(normalise(F.col("last")).alias("cause"), "deck"))
    many = rows.groupBy("cause").agg(F.countDistinct("deck").alias("decks")).where(F.col("decks") >= 2)
    return rows.join(many, "cause")


def diagnose(states: DataFrame, repeated: DataFrame, now_us: Column, acked: DataFrame) -> DataFrame:
    """Alerts (deck, level, what) that nobody has acknowledged yet."""
    open_decks = states.where(~F.col("kind").isin(*SETTLED))
    loops = (repeated.where(F.col("n") >= LOOP_REPEATS).join(open_decks.select("deck"), "deck", "left_semi")
             .select("deck", F.lit("stop").alias("level"),
                     F.concat(F.lit("same complaint "), F.col("n").cast("string"), F.lit("x: "), "complaint").alias("what")))
    escalated = states.where(F.col("kind") == "escalated").select("deck", F.lit("stop").alias("level"), F.lit("escalated").alias("what"))
    blocked = states.where(F.col("kind") == "blocked").select("deck", F.lit("stop").alias("level"), F.lit("waiting on a lock").alias("what"))
    broken = states.where(F.col("kind").isin("crashed", "infra")).select("deck", F.lit("look").alias("level"), F.col("kind").alias("what"))
    named = loops.unionByName(escalated).unionByName(blocked).unionByName(broken)
    idle = F.floor((now_us - F.col("last_us")) / 60000000)
    quiet = (open_decks.where((now_us - F.col("last_us")) / 60000000 >= STALL_MINUTES)
             .join(named.select("deck").distinct(), "deck", "left_anti")
             .select("deck", F.lit("look").alias("level"),
                     F.concat(F.lit("quiet "), idle.cast("string"), F.lit("m")).alias("what")))
    causes = shared_causes(states).groupBy("cause").agg(F.max("decks").alias("n")).select(
        F.lit("").alias("deck"), F.lit("stop").alias("level"),
        F.concat(F.col("n").cast("string"), F.lit(" decks, one cause: "), "cause").alias("what"))
    alerts = named.unionByName(quiet).unionByName(causes)
    return alerts.join(acked, ["deck", "what"], "left_anti")


def supervision_report(states: DataFrame, now_us: Column) -> DataFrame:
    return states.groupBy("kind").agg(
        F.count(F.lit(1)).alias("decks"),
        F.floor((now_us - F.max("last_us")) / 60000000).cast("long").alias("newest_minutes"))
