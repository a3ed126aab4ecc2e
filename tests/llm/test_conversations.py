"""Conversation repair against a plain program over whole conversations."""

import hashlib
import random
import re
import zlib

from gradeloom.llm import conversations

ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
TEXTS = ["Fine.", "Also fine!", "cut off", " ", "", "Is it? ", "Fine.\n", None, "ends here.\x0b", "é no end"]


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit: least cost, then ASCII-least audit."""
    best = {"": (0, "", ())}                                   # kept initials, shortened to what matters

    def shape(s):
        return s if s in ("", "s") else "u" if s[-1] == "u" else "a"

    def grown(states, role, cost, letter, line):
        out = {}
        for s, (c, audit, lines) in states.items():
            t = s + role
            if role and not re.fullmatch("s?(ua)*u?", {"u": "u", "a": "ua"}.get(s, s) + role):
                continue
            t = shape(t) if role else s
            new = (c + cost, audit + letter, (*lines, line) if line is not None else lines)
            if t not in out or new[:2] < out[t][:2]:
                out[t] = new
        return out

    def merged(*many):
        out = {}
        for states in many:
            for s, v in states.items():
                if s not in out or v[:2] < out[s][:2]:
                    out[s] = v
        return out

    def inserted(states):
        for _ in range(3):
            states = merged(states, grown(states, "u", 3, "I", "user:"), grown(states, "a", 3, "I", "assistant:"))
        return states

    for role, text, fault in rows:
        best = inserted(best)
        ways = [grown(best, "", 4, "D", None)]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            if role[:1] in ("s", "u", "a") and role:
                ways.append(grown(best, role[0], more, "K", f"{role}:{text}"))
            ways += [grown(best, r[0], 3 + more, "R", f"{r}:{text}") for r in ("user", "assistant")]
        best = merged(*ways)
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def brute(table):
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if draw == 1:
                text = ""
            if draw == 2:
                text = re.sub("[.!?]", "", text)
            if draw == 4:
                role = "user"
            rows += [(turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in rows:
            last = re.sub("[\x20\x09-\x0d]+$", "", text)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [sum(f == kind for *_, f in marked) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        cost, audit, lines = cheapest(marked)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def table_of(rng, convs, longest):
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, longest)):
            if rng.random() < 0.5:
                row = (turn, ("user", "assistant")[turn % 2], f"Answer {turn}.")
            else:
                row = (rng.choice([turn, turn, None, turn + 5]), rng.choice(ROLES), rng.choice(TEXTS))
            rows += [(conv, *row)] * rng.choice([1, 1, 1, 2])
    return rows


def test_report_against_brute_force(spark):
    rng = random.Random(12)
    rows = table_of(rng, 150, 14) + [(None, 0, "user", "Hi."), (None, None, "assistant", "Yes."), (None, None, None, None)]
    rows += [(5000 + k, 1, "user", "Alone.") for k in range(60)]               # some vanish whole
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, present string").drop("present")
    got = conversations.report(conversations.damage(frame.withColumn("place", frame["turn"]).repartition(7)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert conversations.report(conversations.damage(frame.limit(0))).count() == 0


def test_giant_conversation_over_many_batches(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), f"{t} {rng.choice(['done.', 'open'])}") for t in range(9000)]
    frame = spark.createDataFrame([*rows, (2, 1, "user", "Hi.")], "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = {r["conv_id"]: r for r in conversations.report(conversations.damage(frame)).collect()}
        turns = conversations.repair(conversations.damage(frame).where("present")).where("conv_id = 1").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {r[0]: r for r in brute(rows)}
    assert tuple(got[1]) == want[1]
    turns.sort(key=lambda r: r["place"])
    assert "".join(r["edit"] for r in turns) == got[1]["audit"]
    kept = [r for r in turns if r["edit"] != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in kept))
    assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in kept).encode()).hexdigest() == got[1]["repaired_sha256"]
