"""Token counts, line dedup, decontamination, license scans and toxicity on small fixtures."""

import random

import numpy as np
import pytest

from gradeloom.llm import decontamination, license_scan, line_dedup, token_counts, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b ", "\n", "a\nb", "<s>x</s>", "<0x0A>", "日本語🎉 x", "a\tb　c", "=" * 700, " " * 600 + "x", "a" * 1500,
       "x" * 256 + "é" * 300, "▁a", "ab" * 400, " \n \n  "]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_transducer_counts_as_the_library(library):
    counter = token_counts.Transducer(MODEL)
    rng = random.Random(3)
    made = ["".join(rng.choice("ab the ing\n.,é日ß  x9") for _ in range(rng.randrange(900))) for _ in range(60)]
    assert counter.counts([*ODD, *made]).tolist() == [len(library.encode(t)) for t in [*ODD, *made]]


def test_transducer_survives_an_emptied_table(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_TRANSITIONS", 50)
    counter = token_counts.Transducer(MODEL)
    for text in ODD:
        assert counter.counts([text]).tolist() == [len(library.encode(text))]


def test_token_counts_with_nulls(spark, documents):
    rows = token_counts.count_tokens(documents([(1, None, "a"), (2, "", "a"), (None, "a b", "a"), (2, "", "a")]), MODEL).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [(0, 2), (1, 0), (2, 0), (2, 0)]


def test_line_dedup(spark, documents):
    page = [(k, f"menu\t\nown line {k}\n\nfooter", "s") for k in range(10)]
    rest = [(20, "menu\nother", "t"), (21, None, "s"), (22, "", "s"), (23, "menu", None), (24, "menu", "s"), (24, "menu", "s"), (25, "footer", "s")]
    out = {(r["doc_id"], r["source"]): r for r in line_dedup.clean(documents([*page, *rest]), ratio=0.5).collect()}
    assert out[3, "s"]["text"] == "own line 3\n" and out[3, "s"]["lines_dropped"] == 2 and out[3, "s"]["lines_before"] == 4
    assert out[20, "t"]["text"] == "menu\nother" and out[23, None]["text"] == "menu"
    assert out[21, "s"]["text"] is None and out[22, "s"]["text"] == "" and out[24, "s"]["text"] == ""
    assert out[3, "s"]["_row"] == 1


def test_line_dedup_counts_exact_copies_once(spark, documents):
    copies = [(k, "alpha\nbeta", "s") for k in range(9)]
    out = line_dedup.clean(documents([*copies, (9, "gamma", "s")]), ratio=0.1).collect()
    assert all(r["lines_dropped"] == 0 for r in out)
    assert line_dedup.clean_documents(documents([])).count() == 0


def smith_waterman(item, window):
    h = np.zeros((len(item) + 1, len(window) + 1), int)
    for i, a in enumerate(item):
        for j, b in enumerate(window):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if a == b else -1), h[i, j + 1] - 2, h[i + 1, j] - 2)
    return h.max() / (2 * len(item))


def test_alignment_score_and_seed_bound(spark, documents):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    item = [rng.choice(words) for _ in range(30)]
    block = decontamination.Block.of([(1, " ".join(item))], 3)
    block.choose_seeds({}, 0.8)
    for _ in range(150):
        copy = list(item)
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(copy))
            copy[k:k + 1] = rng.choice([[], [rng.choice(words)], [copy[k], rng.choice(words)]])
        text = [*rng.choices(words, k=40), *copy, *rng.choices(words, k=40)]
        want = smith_waterman(item, text)
        found = block.leaks(" ".join(text), 0.8)
        assert bool(found) == (want >= 0.8)
        if found:
            assert found[0][1] == pytest.approx(want)


def test_decontamination(spark, documents):
    passage = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a tall tree"
    bench = spark.createDataFrame([(7, passage), (8, "two words"), (9, None), (10, "")], "item_id long, text string")
    docs = documents([(1, f"Before. {passage.upper()}! after", "a"), (2, passage.replace("brown", "red"), "a"), (3, "quite another text", "a"),
                      (4, None, "a"), (5, "", "a"), (None, "here are two words.", "a"), (3, "quite another text", "a")])
    got = sorted((r["doc_id"] or 0, r["item_id"]) for r in decontamination.matches(docs, bench).collect())
    assert got == [(0, 8), (1, 7), (2, 7)]
    assert sorted(r["doc_id"] for r in decontamination.without_leaks(docs, bench, block_items=1).collect()) == [3, 3, 4, 5]
    assert decontamination.without_leaks(docs, bench.limit(0)).count() == 7


def test_license_scan(spark, documents):
    mit = ('Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files '
           '(the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, '
           'publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, '
           'subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or '
           'substantial portions of the Software.')
    out = {r["doc_id"]: r for r in license_scan.scan(documents([
        (1, mit, "a"), (2, "no full stop\nReleased under the MIT License.\nAll rights reserved.", "a"), (3, "licensed differently", "a"),
        (4, None, "a"), (5, "", "a"), (6, "Licensed under the Apache License, Version 2.0.", "a")])).collect()}
    assert out[1]["licenses"] == "MIT" and out[1]["sentences"] == "MitGrant MitNotice"
    assert out[2]["licenses"] == "All-Rights-Reserved,MIT" and out[6]["licenses"] == "Apache-2.0"
    assert [out[k]["n_licenses"] for k in (3, 4, 5)] == [0, 0, 0] and out[1]["_row"] == 1


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    plain, bad = [f"word{k}" for k in range(300)], ["vile", "scum", "filth", "wretch"]
    rows, labels = [], []
    for k in range(900):
        toxic = k % 6 == 0
        words = rng.choices(plain, k=60) + (rng.choices(bad, k=4) if toxic else [])
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, 0, int(toxic)))
    docs = spark.createDataFrame([*rows, (5000, None), (5001, ""), (None, "vile scum filth"), (5002, "word1 " * 3000 + "scum vile filth")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    out = toxicity.score(docs, model).withColumn("held", ~toxicity.in_training()).collect()
    by_id = {r["doc_id"]: r for r in out}
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 900 and r["held"]]
    assert len(held) > 200 and all(r["predicted"] == int(r["doc_id"] % 6 == 0) for r in held)
    assert by_id[5000]["score"] == by_id[5001]["score"] < 0.5 and by_id[None]["predicted"] == 1 == by_id[5002]["predicted"]
    empty = toxicity.train(docs, marks.limit(0))
    assert empty is None and {r["score"] for r in toxicity.score(docs, empty).collect()} == {0.5}
