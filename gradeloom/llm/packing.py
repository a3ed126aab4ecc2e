"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens.  Pieces are dealt by hash over chunks of about
``chunk_items``; a chunk is packed by several islands, each a population of whole packings.  Crossover
injects well-filled bins of one parent into the other, takes out the bins that hold the same pieces and
best-fits the displaced ones.  Between epochs each island's elites migrate to the next island of their
chunk.  Islands are rows that hold the chunk's sizes and packings, so an epoch is one narrow map and one
shuffle of a few hundred kilobytes a chunk.  The first packing of every island is best-fit decreasing, so
the result is never worse than that.

Null and empty texts are the end token alone.  Repeated rows are packed each.  Sequences of different
chunks never share a number.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.llm.common import text_batches, written

#: Characters that every Unicode version classes alike.
PLAIN = re.compile("[\\t\\n\\r -~\\u00a1-\\u00ac\\u00ae-\\u017f]*")
#: The byte-level pattern (a fixed value of this kind of tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids as little-endian 32-bit numbers: those of the tokenizers library.

    Plain texts are merged by the same ranks in tiktoken, which is several times faster; texts with
    special strings or with characters whose class depends on the Unicode version go to tokenizers.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = sorted(ByteLevel.alphabet())
        byte_of = {c: ord(c) for c in letters if ord(c) < 256}
        byte_of |= dict(zip((c for c in letters if ord(c) >= 256), (b for b in range(256) if b not in byte_of.values()), strict=True))
        tokens = {bytes(byte_of[c] for c in t): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, so that tasks share it."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(documents: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): texts tokenised, ended, cut; the first piece takes the rest."""
    schema = T.StructType([documents.schema["doc_id"], *(T.StructField(n, t) for n, t in (
        ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())))])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in text_batches(batches, "text"):
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text or "") + end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n % capacity or capacity) if at == 0 else capacity
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at:4 * (at + size)]))
                    at, k = at + size, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select("doc_id", "text").mapInArrow(run, schema)


# ---------------------------------------------------------------- the search inside an island

def best_fit(sizes: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put the items of ``order`` into the open bin with the least sufficient room, else a new one, in place."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, r in enumerate(room):
        if r > 0:
            stacks[r].append(b)
            mask |= 1 << r
    for i, s in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = mask >> s
        if fits and s:
            r = s + (fits & -fits).bit_length() - 1
            b = stacks[r].pop()
            if not stacks[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i] = b
        room[b] = r = r - s
        if r > 0:
            stacks[r].append(b)
            mask |= 1 << r


def packed(sizes: np.ndarray, capacity: int, rng: np.random.Generator | None = None) -> np.ndarray:
    """Best-fit decreasing; with ``rng`` in a slightly shaken order."""
    weight = sizes if rng is None else sizes * rng.uniform(0.8, 1.0, len(sizes))
    bins = np.full(len(sizes), -1, np.int32)
    best_fit(sizes, np.argsort(-weight, kind="stable"), bins, [], capacity)
    return bins


def crossover(giver: np.ndarray, taker: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator, share: float = 0.08) -> np.ndarray:
    """``taker`` with some well-filled bins of ``giver`` injected whole, duplicates out, displaced best-fitted."""
    fill = np.bincount(giver, weights=sizes)
    full = np.argsort(-fill, kind="stable")[:max(1, int(len(fill) * 0.6))]
    chosen = rng.choice(full, max(1, int(len(fill) * share)), replace=False)
    mark = np.zeros(len(fill), bool)
    mark[chosen] = True
    injected = mark[giver]
    broken = np.zeros(int(taker.max()) + 1, bool)
    broken[taker[injected]] = True
    # the emptiest bins of the taker are opened as well: they are what can be saved
    left = np.bincount(taker, weights=sizes)
    broken[np.argsort(left, kind="stable")[:max(1, len(left) // 50)]] = True
    kept = ~broken[taker] & ~injected
    child = np.full(len(sizes), -1, np.int32)
    _, own = np.unique(taker[kept], return_inverse=True)
    _, new = np.unique(giver[injected], return_inverse=True)
    child[kept] = own
    base = int(own.max()) + 1 if len(own) else 0
    child[injected] = new + base
    room = (capacity - np.bincount(child[child >= 0], weights=sizes[child >= 0])).astype(int).tolist()
    loose = np.flatnonzero(child < 0)
    best_fit(sizes, loose[np.argsort(-sizes[loose], kind="stable")], child, room, capacity)
    return child


def fitness(bins: np.ndarray, sizes: np.ndarray) -> tuple[int, float]:
    """Fewer bins first, then more uneven ones, which leave more room to use."""
    fill = np.bincount(bins, weights=sizes)
    return len(fill), -float((fill ** 2).sum())


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, rng: np.random.Generator, *, generations: int, keep: int) -> list[np.ndarray]:
    least = -(-int(sizes.sum()) // capacity)
    ranked = sorted(((fitness(p, sizes), p) for p in population), key=lambda x: x[0])
    for _ in range(generations):
        if ranked[0][0][0] <= least or len(ranked) < 2:
            break
        a, b = rng.choice(len(ranked), 2, replace=False)
        child = crossover(ranked[a][1], ranked[b][1], sizes, capacity, rng)
        ranked = sorted([*ranked, (fitness(child, sizes), child)], key=lambda x: x[0])[:keep]
    return [p for _, p in ranked]


# ---------------------------------------------------------------- islands on Spark

def pack(items: DataFrame, *, capacity: int = 2048, chunk_items: int = 8192, islands: int = 3, epochs: int = 2,
         generations: int = 10, population: int = 4, elites: int = 2) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``.  ``length`` has to be from 1 to ``capacity``."""
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    held = written(items.select(*names).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    chunks = max(1, round(held.count() / chunk_items))
    held = held.withColumn("_chunk", F.pmod(F.xxhash64("_row"), F.lit(chunks)))

    def sizes_of(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame.sort_values("_row")["length"].to_numpy(np.int32)
        return pd.DataFrame({"_chunk": [frame["_chunk"].iloc[0]], "sizes": [sizes.tobytes()]})

    state = (held.select("_chunk", "_row", "length").groupBy("_chunk").applyInPandas(sizes_of, "_chunk long, sizes binary")
             .withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
             .withColumn("packings", F.lit(None).cast("array<binary>")))
    schema = "_chunk long, sizes binary, island int, packings array<binary>"

    def epoch(number: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                grown = []
                for chunk, blob, island, given in zip(frame["_chunk"], frame["sizes"], frame["island"], frame["packings"], strict=True):
                    sizes = np.frombuffer(blob, np.int32)
                    rng = np.random.default_rng([int(chunk), int(island), number])
                    if given is None:
                        start = [packed(sizes, capacity), *(packed(sizes, capacity, rng) for _ in range(population - 1))]
                    else:
                        start = [np.frombuffer(g, np.int32) for g in given]
                    done = evolve(sizes, start, capacity, rng, generations=generations, keep=population)
                    grown.append([p.astype(np.int32).tobytes() for p in done])
                yield frame.assign(packings=grown)
        return run

    for number in range(epochs):
        # few rows, each a long search: one row a task as far as there are tasks
        state = written(state.repartition("_chunk", "island").mapInPandas(epoch(number), schema), "islands")
        if number + 1 < epochs:
            guests = state.select("_chunk", F.expr(f"pmod(island + 1, {islands})").alias("island"),
                                  F.slice("packings", 1, elites).alias("guests"))
            state = (state.join(guests, ["_chunk", "island"])
                     .select("_chunk", "sizes", "island", F.concat("packings", "guests").alias("packings")))

    best = _best(state)

    def placed(chunk_frame: pd.DataFrame, best_frame: pd.DataFrame) -> pd.DataFrame:
        frame = chunk_frame.sort_values("_row")
        where = np.frombuffer(best_frame["packing"].iloc[0], np.int32).astype(np.int64)
        order = np.argsort(where, kind="stable")
        length = frame["length"].to_numpy(np.int64)
        before = np.cumsum(length[order]) - length[order]
        first = np.append(True, where[order][1:] != where[order][:-1])
        offset = np.empty(len(frame), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        return frame[names].assign(sequence_id=frame["_chunk"].to_numpy(np.int64) * (1 << 32) + where, offset=offset)

    out = T.StructType([*(items.schema[n] for n in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return held.groupBy("_chunk").cogroup(best.groupBy("_chunk")).applyInPandas(placed, out)


def _best(state: DataFrame) -> DataFrame:
    """Per chunk the first packing of the island that needs the fewest sequences."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            first = [p[0] for p in frame["packings"]]
            yield pd.DataFrame({"_chunk": frame["_chunk"], "island": frame["island"], "packing": first,
                                "sequences": [int(np.frombuffer(p, np.int32).max()) + 1 for p in first]})

    return (state.mapInPandas(count, "_chunk long, island int, packing binary, sequences int")
            .groupBy("_chunk").agg(F.min_by("packing", F.struct("sequences", "island")).alias("packing")))


def pack_documents(documents: DataFrame, tokenizer: str, *, capacity: int = 2048, **how) -> DataFrame:
    return pack(pieces(documents, tokenizer, capacity=capacity), capacity=capacity, **how)
