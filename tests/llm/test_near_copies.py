"""Near copies that differ by whole passages, and among many texts of the same words."""

import random

import pytest

from gradeloom.llm import simhash

pytest.importorskip("public_tokenizers")


def test_copies_among_texts_of_the_same_words(spark, documents):
    rng = random.Random(12)
    words, rows = [f"w{k}" for k in range(120)], []
    for k in range(150):
        text = rng.sample(words, 120)
        rows.append((k, " ".join(text), "a"))
        text[60], text[61] = text[61], text[60]
        rows.append((1000 + k, " ".join(text), "a"))
    kept = {r["doc_id"] for r in simhash.one_of_each_group(documents(rows)).collect()}
    assert kept == set(range(150))


def similarity(a, b):
    a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(a & b) / len(a | b)


def test_passages_added_cut_and_replaced(spark, documents):
    rng = random.Random(13)
    words, rows = [f"w{k}" for k in range(20000)], []
    for k in range(300):
        text = [rng.choice(words) for _ in range(rng.randrange(60, 300))]
        new, at, copy = [rng.choice(words) for _ in text], rng.randrange(len(text) // 2), None
        for n in range(1, len(text) // 2):
            trial = text[:at] + new[:n if k % 3 != 1 else 0] + text[at + (n if k % 3 else 0):]
            if similarity(text, trial) < 0.8:
                break
            copy = trial
        rows += [(k, " ".join(text), "a"), (1000 + k, " ".join(copy), "a")]
    kept = {r["doc_id"] for r in simhash.one_of_each_group(documents(rows)).collect()}
    assert set(range(300)) <= kept
    assert len(kept) - 300 <= 3


def test_parts_across_others():
    parts = [simhash.Part(tuple(range(k, 512, 37)), 0) for k in range(37)]
    other = simhash.crossed(parts)
    assert sorted(b for p in other for b in p.bits) == list(range(512))
    assert all(len(set(p.bits) & set(q.bits)) <= 1 for p in parts for q in other)
