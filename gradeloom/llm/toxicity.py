"""Toxicity by compression distance: one zstandard dictionary per class, windows compressed with both.

Every word is spelled as a fixed-width code (a hash of the word), so that a word known to a dictionary
costs one match and an unknown one its whole width; the lengths of a window of words under the two
dictionaries then differ by what only one class knows.  The dictionaries are trained on a bounded
sample of labelled rows (``toxic_rows``, ``ordinary_rows``); word counts of that sample are a Spark
aggregation, only words over a significance bound reach the driver.  The window threshold and the
logistic curve are calibrated on the same sample.

Null and empty texts have no window: their score is that of no evidence.  Repeated rows are scored
each.  Labels enter by ``doc_id`` for training only and never the score.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import text_batches, written

WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
CODE_BYTES = 12
#: A whole line of the words above, for Spark's splitter: everything that is not a letter.
NOT_WORD = r"[\x00-\x40\x5b-\x60\x7b-\x7f]+"


@dataclass(frozen=True)
class Model:
    """What a task needs: both dictionaries, the window threshold and the curve."""

    toxic: bytes
    ordinary: bytes
    window: int
    level: int
    evidence: float
    slope: float
    offset: float


def spelled(word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=CODE_BYTES).digest()


def dictionary(special: list[bytes], common: list[bytes], size: int) -> bytes:
    """Raw dictionary of ``size`` bytes, the most telling words last, where matches are cheapest."""
    content = b"".join(spelled(w) for w in reversed([*special, *common]))[-size:]
    return hashlib.shake_128(b"filler").digest(size - len(content)) + content


class Scorer:
    """Window lengths under both dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes, window: int, level: int):
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=False,
                                            write_checksum=False, write_dict_id=False)

        self.toxic, self.ordinary, self.window = compressor(toxic), compressor(ordinary), window
        self.codes: dict[bytes, bytes] = {}

    def gains(self, text: str | None) -> np.ndarray:
        """Per window: bytes that the toxic dictionary saves against the ordinary one."""
        codes, row = self.codes, []
        for word in WORD.findall((text or "").lower().encode("utf-8", "replace")):
            code = codes.get(word)
            if code is None:
                if len(codes) > 1_000_000:
                    codes.clear()
                codes[word] = code = spelled(word)
            row.append(code)
        step, slow, fast = self.window, self.ordinary.compress, self.toxic.compress
        return np.array([len(slow(w)) - len(fast(w))
                         for w in (b"".join(row[i:i + step]) for i in range(0, len(row), step))], dtype=float)


def evidence_of(gains: np.ndarray, least: float) -> float:
    return float(gains[gains >= least].sum())


def in_training(doc_id="doc_id"):
    """Rows whose labels may be learned: crc32 of the id as text, mod 3, is not 1."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1


def train(documents: DataFrame, labels: DataFrame, *, toxic_rows: int = 4000, ordinary_rows: int = 8000,
          special_words: int = 512, common_words: int = 512, window: int = 16, level: int = 3) -> Model | None:
    """Fit on at most ``toxic_rows`` and ``ordinary_rows`` labelled documents, taken by a hash of the id.

    A word is special to a class if its share of the class's texts is 20 times the other's, at least
    1.5 %, and the difference is significant (G2 over 20).  None without rows of both classes.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & in_training())
              .select("doc_id", F.col("toxic").cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = (chosen.where("toxic = 1").orderBy(*order).limit(toxic_rows)
              .unionByName(chosen.where("toxic = 0").orderBy(*order).limit(ordinary_rows)))
    # bounded by the sample; written once, since several counts read it
    texts = written(documents.select("doc_id", "text").join(sample, "doc_id").select("text", "toxic").where("text is not null").distinct(), "labelled-texts")
    words = texts.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), NOT_WORD))).alias("word")).where("word <> ''")
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_ordinary = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_ordinary:
        return None
    counts = words.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    share_a, share_b = (F.col("a") + 0.5) / (n_toxic + 1), (F.col("b") + 0.5) / (n_ordinary + 1)

    def part(count, total):
        expected = (F.col("a") + F.col("b")) * total / (n_toxic + n_ordinary)
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    scored = counts.withColumn("g2", 2 * (part(F.col("a"), n_toxic) + part(F.col("b"), n_ordinary)))

    def telling(mine, other, count, total) -> list[bytes]:
        rows = (scored.where((mine > 20 * other) & (F.col("g2") > 20) & (count >= 0.015 * total))
                .orderBy(F.desc("g2"), "word").limit(special_words).collect())
        return [r["word"].encode() for r in rows]

    toxic_words = telling(share_a, share_b, F.col("a"), n_toxic)
    ordinary_words = telling(share_b, share_a, F.col("b"), n_ordinary)
    known = {*toxic_words, *ordinary_words}
    common = [r["word"].encode() for r in counts.orderBy(F.desc(F.col("a") + F.col("b")), "word").limit(common_words).collect()]
    common = [w for w in common if w not in known]
    size = CODE_BYTES * (max(len(toxic_words), len(ordinary_words)) + len(common))
    toxic, ordinary = dictionary(toxic_words, common, size), dictionary(ordinary_words, common, size)
    if size < 8:
        toxic = ordinary = bytes(8)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(toxic, ordinary, window, level)
        for batch in text_batches(batches, "text"):
            gains = [scorer.gains(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([g[g >= 3].tolist() for g in gains], pa.list_(pa.float64()))], ["toxic", "gains"])

    seen = texts.mapInArrow(measure, "toxic int, gains array<double>").collect()
    least = _window_threshold([g for r in seen if r["toxic"] == 0 for g in r["gains"]], n_ordinary)
    slope, offset = _curve(np.array([sum(g for g in r["gains"] if g >= least) for r in seen]), np.array([r["toxic"] for r in seen]))
    return Model(toxic, ordinary, window, level, least, slope, offset)


def _window_threshold(ordinary_gains: list[float], texts: int) -> float:
    """Smallest gain that at most one ordinary text in 200 reaches by chance."""
    gains = np.array(ordinary_gains)
    for least in range(3, 2 * CODE_BYTES):
        if (gains >= least).sum() <= texts / 200:
            return float(least)
    return float(2 * CODE_BYTES)


def _curve(evidence: np.ndarray, toxic: np.ndarray, rounds: int = 400) -> tuple[float, float]:
    """Logistic curve over log(1 + evidence), classes weighted alike, lightly shrunk (Newton steps)."""
    x = np.stack([np.log1p(evidence), np.ones(len(evidence))], axis=1)
    weight = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum())) * len(toxic)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (toxic - p)) - 0.1 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta += step
        if abs(step).max() < 1e-9:
            break
    return float(max(0.0, beta[0])), float(beta[1])


def score(documents: DataFrame, model: Model | None, *, threshold: float = 0.7) -> DataFrame:
    """``documents`` with ``score``, ``predicted`` and ``evidence`` (bytes saved over all telling windows).

    Columns of those names that are already there are replaced.  Without a model every score is 0.5.
    """
    rest = documents.drop("score", "predicted", "evidence")
    names = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model and Scorer(model.toxic, model.ordinary, model.window, model.level)
        for batch in text_batches(batches, "text"):
            found = [evidence_of(scorer.gains(t), model.evidence) if model else 0.0 for t in batch.column("text").to_pylist()]
            scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * math.log1p(e) + model.offset)))) if model else 0.5 for e in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names if n in kept), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(found, pa.float64())],
                names=[*(n for n in names if n in kept), "score", "predicted", "evidence"])

    kept = set(names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(run, f"{schema}, score double, predicted int, evidence double")


def without_toxic(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **how) -> DataFrame:
    """Documents whose predicted class is ordinary, in their own columns."""
    return score(documents, train(documents, labels, **how), threshold=threshold).where("predicted = 0").select(*documents.columns)
