"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of word characters, lower-cased.  Every item keeps its rarest n-grams (by the number of
training texts that hold them) as seeds; a text that holds a seed is aligned with the item around it.
Scores: match 2, mismatch -1, gap -2; the similarity is the best local score over twice the item's
words.  An alignment of similarity s or more can break at most 2 (1 - s) L of the item's n-grams (an
edit that breaks k of them costs at least k), so the 2 (1 - s) L + 1 rarest are enough to miss none,
and only windows that hold the other n-grams an alignment must keep are aligned.

The benchmark is taken in blocks of about ``block_items`` items; texts are never shuffled.  Items
shorter than ``gram`` words match as a whole, items without words and null or empty texts match
nothing; repeated rows of either side match each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.llm.common import text_batches

WORDS = re.compile(r"\w+")
MATCH, MISMATCH, GAP = 2, -1, -2


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def similarity(item: np.ndarray, window: np.ndarray) -> tuple[float, int]:
    """Best local alignment score over the item's best possible one, and the window word it ends at."""
    before = np.zeros(len(window) + 1, np.int64)
    ramp = -GAP * np.arange(len(window) + 1)
    best, end = 0, 0
    for word in item:
        row = np.zeros(len(window) + 1, np.int64)
        row[1:] = np.maximum(before[:-1] + np.where(window == word, MATCH, MISMATCH), before[1:] + GAP)
        row = np.maximum.accumulate(np.maximum(row, 0) + ramp) - ramp
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
        before = row
    return best / (MATCH * len(item)), end


@dataclass
class Block:
    """Items of one block as word numbers, and their n-grams as sorted codes."""

    ids: list
    items: list[np.ndarray]
    vocabulary: dict[str, int]
    gram: int
    codes: dict[int, np.ndarray] = field(default_factory=dict)  # by n-gram size
    places: dict[int, list[list[tuple[int, int]]]] = field(default_factory=dict)  # code -> (item, position)
    seeds: dict[int, np.ndarray] = field(default_factory=dict)  # code -> is it a seed of some item

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]], gram: int) -> Block:
        vocabulary: dict[str, int] = {}
        kept = [(i, w) for i, t in rows if (w := words_of(t))]
        items = [np.array([vocabulary.setdefault(x, len(vocabulary) + 1) for x in w], np.int64) for _, w in kept]
        block = cls([i for i, _ in kept], items, vocabulary, gram)
        held: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, item in enumerate(items):
            size = min(gram, len(item))
            for p, code in enumerate(block.grams(item, size)[0].tolist()):
                held.setdefault(size, {}).setdefault(code, []).append((k, p))
        for size, by_code in held.items():
            block.codes[size] = np.array(sorted(by_code), np.int64)
            block.places[size] = [by_code[c] for c in sorted(by_code)]
            block.seeds[size] = np.ones(len(by_code), bool)
        return block

    def grams(self, numbers: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the n-grams made of known words only, and where they start."""
        n = len(numbers) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = numbers > 0
        whole = known[:n].copy()
        for k in range(1, size):
            whole &= known[k:n + k]
        at = np.flatnonzero(whole)
        code = numbers[at].astype(np.int64)
        with np.errstate(over="ignore"):
            for k in range(1, size):
                code = code * (len(self.vocabulary) + 1) + numbers[at + k]
        return code, at

    def hits(self, numbers: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into the codes and the places in the text where they occur."""
        code, at = self.grams(numbers, size)
        codes = self.codes[size]
        index = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        found = codes[index] == code
        return index[found], at[found]

    def numbers(self, text: str | None) -> np.ndarray:
        look = self.vocabulary.get
        return np.array([look(w, 0) for w in words_of(text)], np.int64)

    def choose_seeds(self, texts_with: dict[tuple[int, int], int], least: float) -> None:
        """Keep each item's rarest n-grams as seeds."""
        for size in self.codes:
            own: dict[int, list[tuple[int, int, int]]] = {}
            for c, places in enumerate(self.places[size]):
                for item, p in places:
                    own.setdefault(item, []).append((texts_with.get((size, c), 0), p, c))
            self.seeds[size][:] = False
            for item, grams in own.items():
                for _, _, c in sorted(grams)[:int(2 * (1 - least) * len(self.items[item]) + 1e-9) + 1]:
                    self.seeds[size][c] = True

    def leaks(self, text: str | None, least: float) -> list[tuple[int, float, int]]:
        """(item, similarity, last word of the alignment in the text) of each item that the text holds."""
        numbers = self.numbers(text)
        found = []
        for size in self.codes:
            index, at = self.hits(numbers, size)
            if not self.seeds[size][index].any():
                continue
            by_item: dict[int, list[tuple[int, int, bool]]] = {}
            for c, p in zip(index.tolist(), at.tolist(), strict=True):
                for item, q in self.places[size][c]:
                    by_item.setdefault(item, []).append((p - q, q, bool(self.seeds[size][c])))
            for item, marks in by_item.items():
                n = len(self.items[item])
                slack = int((1 - least) * n + 1e-9)
                needed = max(1, int(np.ceil((n - size + 1) - 2 * (1 - least) * n - 1e-9)))
                best = (0.0, 0)
                for lo, hi in _windows(marks, slack, needed):
                    start = max(0, lo - slack)
                    score, end = similarity(self.items[item], numbers[start:hi + n + slack])
                    best = max(best, (score, start + end))
                if best[0] >= least - 1e-12:
                    found.append((item, *best))
        return found


def _windows(marks: list[tuple[int, int, bool]], slack: int, needed: int) -> Iterator[tuple[int, int]]:
    """Runs of diagonals no more than ``slack`` apart with a seed and enough different n-grams of the item."""
    marks.sort()
    start = 0
    for i in range(1, len(marks) + 1):
        if i == len(marks) or marks[i][0] - marks[i - 1][0] > slack:
            run = marks[start:i]
            if any(m[2] for m in run) and len({m[1] for m in run}) >= needed:
                yield run[0][0], run[-1][0]
            start = i


def _blocks(documents: DataFrame, benchmark: DataFrame, least: float, gram: int, block_items: int) -> Iterator[Block]:
    """Blocks of the benchmark with seeds chosen by their counts over all texts."""
    total = benchmark.count()
    parts = max(1, -(-total // block_items))
    for part in range(parts):
        own = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).select("item_id", "text")
        block = Block.of([(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").collect()], gram)
        if not block.items:
            continue

        def count(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            totals = {size: np.zeros(len(c), np.int64) for size, c in block.codes.items()}
            for batch in text_batches(batches, "text"):
                for text in batch.column("text").to_pylist():
                    numbers = block.numbers(text)
                    for size in totals:
                        totals[size][np.unique(block.hits(numbers, size)[0])] += 1
            for size, t in totals.items():
                at = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), size), pa.int32()), pa.array(at, pa.int64()), pa.array(t[at])], ["size", "code", "n"])

        counts = documents.select("text").mapInArrow(count, "size int, code long, n long").groupBy("size", "code").agg(F.sum("n").alias("n")).collect()
        block.choose_seeds({(r["size"], r["code"]): r["n"] for r in counts}, least)
        yield block


def matches(documents: DataFrame, benchmark: DataFrame, *, least: float = 0.8, gram: int = 3, block_items: int = 20_000) -> DataFrame:
    """(doc_id, item_id, similarity, last_word): texts and the items that they hold, at ``least`` or more."""
    schema = T.StructType([documents.schema["doc_id"], benchmark.schema["item_id"],
                           T.StructField("similarity", T.DoubleType()), T.StructField("last_word", T.LongType())])
    item_type = pa.int64() if isinstance(benchmark.schema["item_id"].dataType, T.LongType) else None
    out = documents.sparkSession.createDataFrame([], schema)
    for block in _blocks(documents, benchmark, least, gram, block_items):
        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in text_batches(batches, "text"):
                rows = [(i, *leak) for i, text in enumerate(batch.column("text").to_pylist()) for leak in block.leaks(text, least)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())), pa.array([block.ids[r[1]] for r in rows], item_type),
                     pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64())],
                    ["doc_id", "item_id", "similarity", "last_word"])

        found = documents.select("doc_id", "text").mapInArrow(run, schema)
        out = found if out.isLocal() else out.unionByName(found)
    return out


def without_leaks(documents: DataFrame, benchmark: DataFrame, *, least: float = 0.8, gram: int = 3, block_items: int = 20_000) -> DataFrame:
    """``documents`` that hold no item, in their own columns."""
    out = documents
    for block in _blocks(documents, benchmark, least, gram, block_items):
        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in text_batches(batches, "text"):
                yield batch.filter(pa.array([not block.leaks(t, least) for t in batch.column("text").to_pylist()], pa.bool_()))

        out = out.mapInArrow(run, documents.schema)
    return out
