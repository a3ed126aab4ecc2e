"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

from gradeloom.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    small, large = sorted((a, b), key=len)
    return any(large[:i] + large[i + 1:] == small for i in range(len(large)))


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def spelt(rows, spark):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, word string")
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.group_spellings(frame).collect()}


def test_variants_against_brute_force(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(6, 11))) for _ in range(60)]
    rows = []
    for k in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(base[:rng.choice([3, 10, 60])])
            if rng.random() < 0.2:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcÉZ") + w[i:], w[:i] + "b" + w[i + 1:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((k, rng.choice([" ", ", ", "1"]).join(words)))
    rows += [(None, rows[0][1]), (1, rows[1][1]), (700, None), (701, ""), (702, "aaaaaaa aaaaaaaa aaaaaaaaa " * 3), (703, "×÷×÷×÷× ×÷×÷×÷ ×÷×÷×÷×÷ " * 2),
             (704, "x" * 3000 + " " + "x" * 3001 + " " + "x" * 1500 + "y" + "x" * 1499), (705, "x" * 3000 + " " + "x" * 3001 + " " + "x" * 1500 + "y" + "x" * 1499)]
    rows += [(800 + k, w) for k, w in enumerate(["chainabc"] * 4 + ["chainabd"] * 60 + ["chainaxd"] * 900)]
    want = brute(rows)
    assert len(want) > 300 and any(f and f != r for _, f, r, *_ in want) and max(w[4] for w in want) > 5
    assert spelt(rows, spark) == want


def test_words_without_neighbours_and_empty_tables(spark):
    assert spelt([(1, "solitary solitary short short")], spark) == {("solitary", None, "solitary", 2, 0, None)}
    assert spelt([(1, None), (2, "")], spark) == set()
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_spellings(frame).count() == 0


def test_near_words_at_both_ends(spark):
    words = ["planted", "lanted", "plante", "xplanted", "plantedx", "qlanted", "plantet", "planetd", "pplanted", "planteed"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = {(r["word"], r["near"]) for r in spelling.near_words(frame).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_no_table_goes_through_the_driver(spark, monkeypatch):
    words = [f"word{chr(97 + i)}{chr(97 + j)}xyz" for i in range(6) for j in range(6)]
    rows = spark.createDataFrame([(i, f"{w} " * (2 + 30 * (i % 5 == 0))) for i, w in enumerate(words)], "doc_id long, text string")
    plans, written = [], spelling.written

    def planned(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, label)

    monkeypatch.setattr(spelling, "written", planned)
    plans.append(("variants", spelling.group_spellings(rows)._jdf.queryExecution().executedPlan().toString()))
    assert {"trie-paths", "trie-frontier", "near-words", "forms", "roots", "variants"} <= {label for label, _ in plans}
    assert not [label for label, plan in plans if "Broadcast" in plan]
