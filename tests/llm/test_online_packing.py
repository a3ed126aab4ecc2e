"""Sum-of-squares packing: the rule against its definition, and every id back in place."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import online_packing
from gradeloom.llm.packing import encoder

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_choice_is_the_least_sum_of_squares():
    rng = random.Random(2)
    packer = online_packing.Packer(32, 1000)
    for k in range(600):
        size = rng.choice([1, 3, 5, 8, 13, 20, 31, 32])

        def squares(level, size=size):
            after = packer.levels.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 32
            return int((after ** 2).sum())

        options = {h: squares(h) for h in range(33 - size) if h == 0 or packer.levels[h]}
        assert packer.choose(size) == min(options, key=lambda h: (options[h], -h))
        packer.add(k, bytes(4 * size))
        assert packer.levels.tolist()[1:32] == [len(w) for w in packer.windows[1:]]
    placed = sum(len(p) for w in [*packer.closed, *(w for level in packer.windows for w in level)] for p in w)
    packer.finish()
    lengths = [sum(map(len, w)) for w in packer.closed]
    assert sum(lengths) == placed and all(n == 32 or n & (n - 1) == 0 for n in lengths) and sum(n < 32 for n in lengths) <= 5


def check(rows, out, capacity):
    encode = encoder(PATH)
    by_window, tokens = {}, 0
    for r in out:
        by_window.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    wanted = sorted((-1 if d is None else d, zlib.crc32(encode(t or "") + bytes(4)), len(encode(t or "")) // 4 + 1) for d, t in rows)
    assert sum(r["length"] for r in out) == sum(n for *_, n in wanted)
    for doc in {d for d, _ in rows}:
        texts = [encode(t or "") + bytes(4) for d, t in rows if d == doc]
        pieces = [r for r in out if r["doc_id"] == doc]
        covered = np.zeros(max(len(t) // 4 for t in texts), int)
        for r in pieces:
            span = slice(4 * r["start"], 4 * (r["start"] + r["length"]))
            assert any(zlib.crc32(t[span]) == r["ids_crc32"] and r["doc_tokens"] == len(t) // 4 for t in texts)
            covered[r["start"]:r["start"] + r["length"]] += 1
        assert covered.tolist() == np.sum([np.pad(np.ones(len(t) // 4, int), (0, len(covered) - len(t) // 4)) for t in texts], axis=0).tolist()
    for places in by_window.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0


@pytest.mark.parametrize("most_open", [4096, 3])
def test_round_trip_without_padding(spark, documents, most_open):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(["tree", "house", "of", "x9", "é"]) for _ in range(rng.randrange(1, 90)))) for k in range(200)]
    rows += [(900, None), (901, ""), (902, "tree " * 700), (902, "tree " * 700), (None, "of")]
    frame = documents([(*r, "a") for r in rows]).withColumn("offset", F.lit(5))
    out = online_packing.pack_documents(frame.repartition(3), PATH, capacity=128, most_open=most_open).collect()
    check(rows, out, 128)
    cuts = len(out) - sum(-(-(len(encoder(PATH)(t or "")) // 4 + 1) // 128) for _, t in rows)
    assert cuts < 80 or most_open == 3


def test_empty_table_and_empty_texts(spark, documents):
    assert online_packing.pack_documents(documents([]), PATH).count() == 0
    rows = [(k, "") for k in range(2500)]
    out = online_packing.pack_documents(documents([(*r, "a") for r in rows]).coalesce(1), PATH).collect()
    check(rows, out, 1024)
    assert len(out) == 2500
