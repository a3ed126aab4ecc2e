"""Publication tables: approval, stable ids, routing and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.ordered import ranked_rows, running_sum
from gradeloom.functions.text import rule_case
from gradeloom.session import cut_lineage

# File names that are answer material.
ANSWER_FILES = ("source.pptx", "delta.json", "recipe.json", "proposal.json", "manifest.json",
                "solvability.json", "roundtrip.json", "roundtrip-wps.json", "repair.md",
                "plan.json", "gt_inventory.json", "init_inventory.json")
FILES_PER_COMMIT = 90

INFRA, BROKEN, OK, UNATTRIBUTED = "infrastructure", "task_broken", "ok", "unattributed"

# Failure signatures in order; (verdict, reason, whether it means too much was asked, pattern).
FAILURE_SIGNATURES = [
    (INFRA, "vCPU limit reached", True, r"VcpuLimitExceeded"),
    (INFRA, "instance limit reached", True, r"InstanceLimitExceeded"),
    (INFRA, "no capacity for the instance type", True, r"InsufficientInstanceCapacity"),
    (INFRA, "spot count limit reached", True, r"MaxSpotInstanceCountExceeded"),
    (INFRA, "provisioning calls throttled", True, r"RequestLimitExceeded|\bThrottl"),
    (INFRA, "machine answered 5xx", False, r"\b50[234]\b|Bad Gateway|Service Unavailable|Gateway Time"),
    (INFRA, "connection to the machine failed", False,
     r"Connection refused|Connection reset|Connection aborted|Remote end closed|Max retries exceeded"
     r"|NewConnectionError|ConnectionError|ProtocolError|IncompleteRead"),
    (INFRA, "machine did not come up in time", False,
     r"(?i)read timed out|readtimeout|connecttimeout|timed out waiting|did not become ready|never came up"),
    (INFRA, "cloud call failed", False,
     r"EndpointConnectionError|BotoCoreError|NoCredentialsError|Unable to locate credentials|ExpiredToken|AuthFailure"),
    (INFRA, "cloud account misconfigured", False,
     r"InvalidSubnetID|InvalidGroup|InvalidAMIID|UnauthorizedOperation"),
    (BROKEN, "fetched file is not there", False, r"\b404\b|Not Found|EntryNotFound|RepositoryNotFound"),
    (BROKEN, "fetch refused", False, r"\b40[13]\b|Unauthorized|Forbidden|GatedRepo"),
    (BROKEN, "materials check failed", False, r"AssetFetchError"),
    (BROKEN, "fetched file is damaged", False, r"did not arrive intact"),
    (BROKEN, "task file does not import", False, r"ModuleNotFoundError|ImportError|cannot import name"),
    (BROKEN, "task file does not parse", False, r"SyntaxError|IndentationError"),
    (BROKEN, "task read a missing file", False, r"No such file or directory|FileNotFoundError"),
    (BROKEN, "task raised during setup", False,
     r"AttributeError|NameError|TypeError|KeyError|IndexError|JSONDecodeError|ValueError"),
]


def approved(decks: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """(deck, approved, reason): shipped and packaged; an allow-list may only name known decks."""
    asked = decks if allow is None else decks.join(allow, "deck", "left_semi")
    reason = (F.when(~F.col("outcome").eqNullSafe(F.lit("shipped")), "outcome is not shipped")
              .when(F.col("packaged").isNull(), "not packaged")
              .when(F.col("packaged") != "ok", "packaged is not ok"))
    rows = asked.select("deck", reason.isNull().alias("approved"), reason.alias("reason"))
    if allow is None:
        return rows
    unknown = allow.join(decks, "deck", "left_anti").select(
        "deck", F.lit(False).alias("approved"), F.lit("allow-list names an unknown deck").alias("reason"))
    return rows.unionByName(unknown)


def shared_keys(rows: DataFrame) -> DataFrame:
    """Source keys claimed by more than one entity."""
    return (rows.groupBy("source_key").agg(F.countDistinct("deck").alias("claims"), F.min("deck").alias("first_deck"))
            .where(F.col("claims") > 1))


def allocate(keys: DataFrame, registry: DataFrame, reserved: DataFrame, next_id: int, last: int) -> DataFrame:
    """Id per source key: known keys keep theirs, new keys in order take the next free numbers.

    The p-th new key takes ``next_id + p`` moved up by the taken numbers at or below it.  A taken number
    ``t`` that is the j-th taken one has ``t - next_id - j`` free numbers before it, so counting the taken
    numbers whose free count is at most p gives the shift.  Both sides are numbered with a distributed
    rank, merged in one order and counted with a block-wise running sum.
    """
    known = keys.join(registry.select("source_key", "id"), "source_key")
    fresh = keys.join(registry.select("source_key"), "source_key", "left_anti")
    placed = ranked_rows(fresh, [F.col("ord")], "p")
    start = F.lit(next_id)
    taken = registry.select("id").unionByName(reserved.select("id")).distinct().where(F.col("id") >= start)
    taken = ranked_rows(taken, [F.col("id")], "j").select(
        F.lit(None).cast("string").alias("source_key"), F.lit(None).cast("long").alias("ord"),
        (F.col("id") - start - F.col("j")).alias("pos"), F.lit(1).alias("taken"))
    wanted = placed.select("source_key", "ord", F.col("p").alias("pos"), F.lit(0).alias("taken"))
    merged = (wanted.unionByName(taken).withColumn("__all", F.lit(1))
              .withColumn("__block", F.floor(F.col("pos") / 10000))
              .withColumn("__side", 1 - F.col("taken")))
    counted = running_sum(merged, ["__all"], "__block", ["pos", "__side", "ord"], F.col("taken"), "shift")
    new = (counted.where(F.col("taken") == 0)
           .select("source_key", "ord", (start + F.col("pos") + F.col("shift")).alias("id"),
                   F.lit(True).alias("fresh")))
    old = known.select("source_key", "ord", "id", F.lit(False).alias("fresh"))
    return old.unionByName(new).withColumn(
        "problem", F.when(F.col("fresh") & (F.col("id") > last), "series is full"))


def survey(registry: DataFrame, occupants: DataFrame) -> DataFrame:
    """Ids present but not registered, and registered but not present."""
    both = registry.select("id", F.col("source_key").alias("registered_key")).join(
        occupants.select("id", F.lit(True).alias("__here")), "id", "full")
    note = (F.when(F.col("registered_key").isNull(), "present, not registered")
            .when(F.col("__here").isNull(), "registered, not present"))
    return both.withColumn("note", note).where(note.isNotNull()).select("id", "note")


def conflicts(mapping: DataFrame, occupants: DataFrame, known: DataFrame) -> DataFrame:
    """Wanted ids that something else already holds."""
    held = occupants.select("id", F.col("source_key").alias("held"), F.lit(True).alias("__here"))
    before = known.select("id", F.lit(True).alias("__known"))
    rows = mapping.join(held, "id").where(~F.col("held").eqNullSafe(F.col("source_key"))).join(before, "id", "left")
    return rows.select("id", "source_key", F.when(F.coalesce("held", F.lit("")) != "", "held by another key")
                       .when(F.col("__known"), "registered, holder unknown")
                       .otherwise("occupied by an unknown file").alias("problem"))


def route_files(files: DataFrame) -> DataFrame:
    """Destination of each package file and whether it would leak the answer."""
    asset = F.col("path").startswith("assets/")
    leaf = F.element_at(F.split("path", "/"), -1)
    return (files.withColumn("target", F.when(asset, "dataset").otherwise("repository"))
            .withColumn("destination", F.when(asset, F.regexp_replace("path", "^assets/", "")).otherwise(F.col("path")))
            .withColumn("leak", asset & leaf.isin(*ANSWER_FILES)))


def text_leaks(documents: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, item_id) where a document holds a forbidden passage word for word.

    A passage is keyed by its first four words, or all but its last word when it is shorter (the last one may
    go on in the document).  Documents emit the distinct hashes of their word runs of the lengths in use, so the search is an equi-join on
    whole texts; the few candidate pairs are then checked against the full passage.  When passages
    are few, adaptive execution broadcasts their keys and no document text is shuffled.
    """
    def words(col: str) -> Column:
        return F.split(F.trim(F.col(col)), r"\s+")

    def key(run: Column) -> Column:
        return F.xxhash64(F.concat_ws(" ", run))

    keyed = (passages.withColumn("w", words("text")).where(F.length(F.trim("text")) > 0)
             .withColumn("k", F.greatest(F.lit(1), F.least(F.lit(4), F.size("w") - 1)))
             .select("item_id", "k", key(F.slice("w", F.lit(1), F.col("k"))).alias("key")))
    sizes = keyed.select("k").distinct()                                # at most four rows
    runs = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - F.col("k") + 1, F.lit(1))),
        lambda i: key(F.slice("w", i, F.col("k")))))
    seen = (documents.withColumn("w", words("text")).join(F.broadcast(sizes), how="cross")
            .select("doc_id", "k", F.explode(runs).alias("key")))
    pairs = seen.join(keyed, ["k", "key"]).select("doc_id", "item_id").distinct()
    return (pairs.join(documents.select("doc_id", "text"), "doc_id")
            .join(passages.select("item_id", F.col("text").alias("passage")), "item_id")
            .where(F.contains("text", F.col("passage"))).select("doc_id", "item_id"))


def commit_batches(tasks: DataFrame, limit: int = FILES_PER_COMMIT, block: int = 5000) -> DataFrame:
    """Greedy batches of at most ``limit`` files in order; an oversize task stands alone.

    Greedy filling is sequential, but its state is only the number of files in the open batch.  Each
    block of tasks is summarised as a table from entry state to exit state and batches closed.  Tables compose,
    so a prefix scan in as many rounds as the number of blocks has bits gives every block the table of all
    blocks up to it, one row a block; each block is then numbered from its true entry state.
    """
    import numpy as np
    import pandas as pd

    states = limit + 2            # 0 = nothing open, s = s files, limit + 1 = an oversize batch

    def advance(fill: "np.ndarray", size: int) -> tuple["np.ndarray", "np.ndarray"]:
        closes = (fill > 0) & (fill + size > limit)
        total = np.where(closes, size, fill + size)
        return np.minimum(total, limit + 1), closes

    def table(pdf: "pd.DataFrame") -> "pd.DataFrame":
        fill, closed = np.arange(states), np.zeros(states, dtype="int64")
        for size in pdf.sort_values("nth")["files"]:
            fill, closes = advance(fill, int(size))
            closed += closes
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "leave": [fill.tolist()], "closed": [closed.tolist()]})

    def number(pdf: "pd.DataFrame") -> "pd.DataFrame":
        pdf = pdf.sort_values("nth")
        fill, batch, out = np.array([int(pdf["enter"].iloc[0])]), int(pdf["from_batch"].iloc[0]), []
        for size in pdf["files"]:
            fill, closes = advance(fill, int(size))
            batch += int(closes[0])
            out.append(batch)
        return pd.DataFrame({"ord": pdf["ord"].to_numpy(), "files": pdf["files"].to_numpy(), "batch": out})

    placed = ranked_rows(tasks.select("ord", "files"), [F.col("ord")], "nth").withColumn(
        "block", F.floor(F.col("nth") / block))
    tables = placed.groupBy("block").applyInPandas(table, "block long, leave array<long>, closed array<long>")
    upto, reach = cut_lineage(tables), 1
    last = upto.agg(F.max("block")).first()[0] or 0
    while reach <= last:
        before = upto.select((F.col("block") + reach).alias("block"), F.col("leave").alias("l"), F.col("closed").alias("c"))
        then = F.transform("l", lambda s: F.element_at("leave", (s + 1).cast("int")))
        more = F.zip_with("c", "l", lambda c, s: c + F.element_at("closed", (s + 1).cast("int")))
        upto = cut_lineage(upto.join(before, "block", "left").select(
            "block", F.when(F.col("l").isNull(), F.col("leave")).otherwise(then).alias("leave"),
            F.when(F.col("l").isNull(), F.col("closed")).otherwise(more).alias("closed")))
        reach *= 2
    entries = upto.select((F.col("block") + 1).alias("block"), F.element_at("leave", 1).alias("enter"), F.element_at("closed", 1).alias("from_batch"))
    placed = placed.join(entries, "block", "left").fillna(0, ["enter", "from_batch"])
    return placed.groupBy("block").applyInPandas(number, "ord long, files long, batch long")


# Verdicts by the status of a run whose texts name no known failure.
STATUS_VERDICTS = [
    ("task_load_failed", BROKEN, "the task file could not be loaded"),
    ("import_failed", INFRA, "the runner could not import the harness"),
    ("ami_resolve_failed", INFRA, "no machine image for the region and screen size"),
    ("interrupted", INFRA, "interrupted before it finished"),
    ("running", INFRA, "the runner died before it wrote a verdict"),
]


def publish_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("target").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
                                      F.countDistinct("deck").alias("decks"))


def failure_verdict(reports: DataFrame) -> DataFrame:
    """What a smoke test proved: message first, then traceback, then cause lines, then the status; else unattributed.

    A run without a result file (``has_result`` false) is judged by the tail of what it said (``note``).
    """
    labels = [(str(i), pattern) for i, (_, _, _, pattern) in enumerate(FAILURE_SIGNATURES)]

    def scan(col: str) -> Column:
        return rule_case(F.coalesce(col, F.lit("")), labels).cast("int")

    told = F.coalesce("has_result", F.lit(True))
    rule = F.when(told, F.coalesce(scan("message"), scan("traceback"), scan("causes"))).otherwise(scan("note"))
    verdicts = F.array(*[F.lit(v) for v, _, _, _ in FAILURE_SIGNATURES])
    reasons = F.array(*[F.lit(r) for _, r, _, _ in FAILURE_SIGNATURES])
    capacity = F.array(*[F.lit(c) for _, _, c, _ in FAILURE_SIGNATURES])
    passed = told & (F.col("status") == OK) & F.col("success")
    status = F.when(told, F.col("status"))
    by_status = F.create_map(*[F.lit(x) for s, v, _ in STATUS_VERDICTS for x in (s, v)])
    why = F.create_map(*[F.lit(x) for s, _, w in STATUS_VERDICTS for x in (s, w)])
    rows = reports.withColumn("__rule", rule)
    return (rows.withColumn("verdict", F.when(F.col("timed_out"), INFRA).when(passed, OK)
                            .when(F.col("__rule").isNotNull(), F.get(verdicts, F.col("__rule")))
                            .otherwise(F.coalesce(F.try_element_at(by_status, status), F.lit(UNATTRIBUTED))))
            .withColumn("reason", F.when(F.col("timed_out"), "passed its deadline").when(passed, "setup ran")
                        .when(F.col("__rule").isNotNull(), F.get(reasons, F.col("__rule")))
                        .otherwise(F.coalesce(F.try_element_at(why, status), F.when(~told, "no result was written").otherwise("not attributed"))))
            .withColumn("capacity", F.coalesce(F.when(~F.col("timed_out") & ~passed, F.get(capacity, F.col("__rule"))), F.lit(False)))
            .drop("__rule"))


def outcome_report(verdicts: DataFrame, shippable: Sequence[str] = (OK,)) -> DataFrame:
    return verdicts.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("capacity").alias("capacity_refusals")).select(
        "verdict", "n", "capacity_refusals", F.col("verdict").isin(*shippable).alias("ships"),
        F.col("verdict").isin(INFRA, UNATTRIBUTED).alias("unverified"))
