"""Conversation structure repair by secondary-sorted streaming.

One shuffle brings a conversation's rows together; everything after it is local to the partition and
streams.  Rows sorted from the last turn to the first feed the dynamic program: its state is four relative
costs, one per place in ``(s?(ua)+)?`` (nothing yet, after s, after u, after a), carried over Arrow batches.
Each row leaves with one byte, the best edit in each of the four states.  These back-pointers go with their
rows through Spark's sorter, which spills them to disk, so a conversation of any length needs no memory
of its own.  Rows sorted from the first turn to the last then follow the back-pointers and come out repaired.

A conversation is one stream, however long: its repaired text has one running digest, which no
split can compute.  No task ever holds more of it than a batch.

Defined results: a null role or text is one space; null turns come first; rows of one turn are taken by role, then
text; repeated rows are duplicates but for the first.  A role counts by its first character, an empty one fits
nowhere.  Null conversation ids are one conversation.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a.  The one role but s that may follow, and where it leads.
NEEDS = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
#: Edits in ASCII order, as two bits of a back-pointer.
EDITS = "DIKR"
#: Relative costs at the end: what it takes to get to an accepted place.
AT_END = (0, 2 * INSERT, INSERT, 0)
FAULTS = ("blank", "duplicate", "truncated")
#: Rows a streamed batch brings out at once.
BATCH = 4096
BLANK = r"[^\x20\x09-\x0D]"
WHOLE = r"[.!?][\x20\x09-\x0D]*\z"
TURNS = "conversation string, turn string, place long, edit string, role string, text string, given string, fault string"


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with planted faults by crc32 of ``conv_id:turn``, and ``present``: false for a dropped row."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat_ws(":", *named)) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), draw.alias("_draw"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_draw").isin(0, 1), "").when(F.col("_draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_draw") != 0).alias("present"), F.when(F.col("_draw") == 3, 2).otherwise(1).alias("_times"))
    return rows.withColumn("_times", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("_times")


def _class_of(role: str | None, fault: str | None) -> tuple[str, str]:
    return (role or "")[:1], fault or ""


_steps: dict[tuple, tuple[tuple[int, ...], int]] = {}


def step(after: tuple[int, ...], row: tuple[str, str]) -> tuple[tuple[int, ...], int]:
    """Relative costs before a row from those after it, and the row's back-pointers (two bits a state)."""
    known = _steps.get((after, row))
    if known:
        return known
    initial, fault = row
    extra = TRUNCATED if fault == "truncated" else 0
    stays = fault not in ("blank", "duplicate")
    handled = []
    for q, (_, to) in enumerate(NEEDS):
        options = {"D": DELETE + after[q]}
        if stays:
            options["R"] = REROLE + extra + after[to]
            if initial == "s" and q == 0:
                options["K"] = extra + after[1]
            elif initial and initial == NEEDS[q][0][0]:
                options["K"] = extra + after[to]
        handled.append(options)
    least = [min(o.values()) for o in handled]
    for _ in range(2):                                            # at most two inserts in a row pay
        least = [min(own, INSERT + least[NEEDS[q][1]]) for q, own in enumerate(least)]
    plan = 0
    for q, options in enumerate(handled):
        options["I"] = INSERT + least[NEEDS[q][1]]
        edit = min(e for e, cost in options.items() if cost == least[q])
        plan |= EDITS.index(edit) << 2 * q
    low = min(least)
    found = tuple(c - low for c in least), plan
    if len(_steps) < 100_000:
        _steps[after, row] = found
    return found


def _plans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows from last to first, each with its number from the end and its back-pointers."""
    current, costs, seq = object(), AT_END, 0
    for frame in frames:
        seqs, plans = [], []
        for key, role, fault, present in zip(frame["conversation"], frame["role"], frame["fault"], frame["present"], strict=True):
            if key != current:
                current, costs, seq = key, AT_END, 0
            plan = 0
            if present:
                costs, plan = step(costs, _class_of(role, fault))
                seq += 1
            seqs.append(seq)
            plans.append(plan)
        yield frame.assign(seq=seqs, plan=pd.Series(plans, dtype="int16"))


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Rows from first to last as repaired rows (see ``TURNS``); edit '' marks a row that only names its conversation."""
    current, state, place, begun = None, 0, 0, False

    def ending() -> Iterator[tuple]:
        at, n = state, place
        while at not in (0, 3):
            role, at = NEEDS[at]
            yield current, None, n, "I", role, "", None, None
            n += 1

    for frame in frames:
        for key, turn, role, text, fault, present, plan in zip(
                *(frame[c] for c in ("conversation", "turn", "role", "text", "fault", "present", "plan")), strict=True):
            if not begun or key != current:
                if begun:
                    yield from ending()
                current, state, place, begun = key, 0, 0, True
            if not present:
                yield current, turn, -1, "", None, None, None, None
                continue
            edit = EDITS[plan >> 2 * state & 3]
            while edit == "I":
                made, state = NEEDS[state]
                yield current, None, place, "I", made, "", None, None
                place += 1
                edit = EDITS[plan >> 2 * state & 3]
            given = role
            if edit == "R":
                role, state = NEEDS[state]
            elif edit == "K":
                state = 1 if role[:1] == "s" else NEEDS[state][1]
            yield current, turn, place, edit, role, text, given, fault
            place += 1
    if begun:
        yield from ending()


def _turns(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in TURNS.split(", ")]
    held = []
    for row in _walk(frames):
        if row[3]:
            held.append(row)
        if len(held) == BATCH:
            yield pd.DataFrame(held, columns=names)
            held = []
    if held:
        yield pd.DataFrame(held, columns=names)


class _Report:
    """Running figures of one conversation."""

    def __init__(self):
        self.first = self.last = None
        self.turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(FAULTS, 0)
        self.audit, self.digest, self.empty, self.before = [], hashlib.sha256(), True, None

    def add(self, turn: str | None, edit: str, role: str, text: str, given: str | None, fault: str | None) -> None:
        if not edit:
            return
        self.audit.append(edit)
        if edit != "I":
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last = turn
                self.turns += 1
            if fault:
                self.faults[fault] += 1
            if self.before is not None and self.before + given[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = given[:1]
        self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit]
        if edit in "KR" and fault == "truncated":
            self.cost += TRUNCATED
        if edit != "D":
            self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def row(self, key: str | None) -> tuple:
        gaps = 0 if self.first is None else int(self.last) - int(self.first) + 1 - self.turns
        return (key, gaps, *(self.faults[f] for f in FAULTS), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def _reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["conversation", "gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256"]
    current, report, held = None, None, []
    for key, turn, _, edit, role, text, given, fault in _walk(frames):
        if report is None or key != current:
            if report:
                held.append(report.row(current))
            current, report = key, _Report()
            if len(held) >= BATCH:
                yield pd.DataFrame(held, columns=names)
                held = []
        report.add(turn, edit, role, text, given, fault)
    if report:
        held.append(report.row(current))
    if held:
        yield pd.DataFrame(held, columns=names)


def _fault(first: Column) -> Column:
    return (F.when(~F.col("text").rlike(BLANK), "blank").when(~first, "duplicate").when(~F.col("text").rlike(WHOLE), "truncated"))


def planned(conversations: DataFrame) -> DataFrame:
    """Rows with ``fault`` and back-pointers, partitioned by conversation and sorted from first to last turn."""
    present = F.coalesce(F.col("present"), F.lit(True)) if "present" in conversations.columns else F.lit(True)
    rows = conversations.select(
        "conv_id", F.col("turn").alias("_turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        present.alias("present")).repartition("conv_id")
    same = F.sha2(F.concat(F.hex("role"), F.lit(":"), "text"), 256)
    seen = Window.partitionBy("conv_id", "present", "_same").orderBy(F.col("_turn").asc_nulls_first())
    rows = rows.withColumn("_same", same).withColumn("_n", F.row_number().over(seen)).drop("_same")
    rows = rows.withColumn("fault", _fault(F.col("_n") == 1))
    # dropped rows come last on the way to the front, so that they never part the others
    rows = rows.sortWithinPartitions("conv_id", F.col("_turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("_n"))
    slim = rows.select(F.col("conv_id").cast("string").alias("conversation"), F.col("_turn").cast("string").alias("turn"), "role", "text", "fault", "present")
    back = slim.mapInPandas(_plans, "conversation string, turn string, role string, text string, fault string, present boolean, seq long, plan short")
    return back.sortWithinPartitions("conversation", F.desc("seq"), F.desc("present"))


def _named(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    kind = conversations.schema["conv_id"].dataType
    rest = [c for c in rows.columns if c != "conversation"]
    return rows.select(F.col("conversation").cast(kind).alias("conv_id"), *rest)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, place, edit, role, text, given, fault): every edit in order, with the repaired role and text.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text``.  Edits are K(eep), R(erole), D(elete) and I(nsert); rows
    but the deleted ones, by ``place``, are the repaired conversation.  ``given`` is the role before the repair.
    """
    return _named(planned(conversations).mapInPandas(_turns, TURNS), conversations)


def report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: gaps in its turns, faults, illegal neighbours, the cheapest repair and its digest.

    With a boolean column ``present``, rows where it is false only name their conversation.
    """
    schema = "conversation string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _named(planned(conversations).mapInPandas(_reports, schema), conversations)
