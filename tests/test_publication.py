"""Commit batches over many blocks and short forbidden passages."""

import random

import pytest

from gradeloom.operators import publication as U


@pytest.mark.parametrize(("n", "block"), [(2500, 4), (30, 100), (1, 5), (0, 5)])
def test_commit_batches_equal_the_plain_fold(spark, n, block):
    rng = random.Random(n)
    sizes = [rng.choice([1, 2, 30, 60, 89, 90, 91, 200]) for _ in range(n)]
    want, held, batch = [], 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > 90:
            batch, held = batch + 1, 0
        held += size
        want.append((k, size, batch))
    tasks = spark.createDataFrame(list(enumerate(sizes)), "ord long, files long").repartition(3)
    assert sorted(tuple(r) for r in U.commit_batches(tasks, block=block).select("ord", "files", "batch").collect()) == want


def test_short_passages_are_found_by_all_but_their_last_word(spark):
    docs = spark.createDataFrame([(1, "say the words now"), (2, "the worded one"), (3, "the other words"), (4, None), (5, ""), (6, "one lone token here now ok")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the word"), (2, "say the words"), (3, "lone"), (4, ""), (5, None), (6, "lone token here now ok")], "item_id long, text string")
    assert sorted(tuple(r) for r in U.text_leaks(docs, items).collect()) == [(1, 1), (1, 2), (2, 1), (6, 3), (6, 6)]
