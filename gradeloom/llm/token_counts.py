"""Token counts by a compiled finite-state transducer.

The pair-merging tokenizer is turned into a deterministic transducer over characters.  A prefix of a text
has one last token, the one that ends there and merges with its neighbour in no other way; so the
state after a character is the list of unfinished token starts (where each stands in the vocabulary's
trie, the token before it, and the tokens emitted since), and a transition carries the change of the
token count.  States and transitions are compiled when first met and kept in a hash table, which is
emptied if it outgrows ``MOST_TRANSITIONS``.

Texts are cut into chunks of ``CHUNK`` characters that run through the transducer side by side.  No
token spans two characters that no vocabulary piece has side by side, so behind the first such place
a chunk's end state and count do not depend on its start: its state map is constant but for its head.
The maps compose in a prefix scan: end states of chunks with such a place are known at once, heads
follow from the chunk before, and a run of chunks without one is composed from left to right.

Null and empty texts have no tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.llm.common import text_batches

CHUNK = 256
MOST_TRANSITIONS = 1 << 21
MARK = "▁"
START, IDLE = 0, 1


class Vocabulary:
    """Pieces with their ranks, from a sentencepiece model of the pair-merging kind."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError("unused pieces are not supported")
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}

    def merged(self, text: str) -> list[str]:
        """The tokens of a short string: best-ranked neighbours first, leftmost among equals."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


class Transducer:
    """Lazily compiled transitions over symbol classes."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        pieces = self.vocabulary.rank
        chars = sorted({c for p in pieces if len(p) > 1 for c in p})
        self.char_of = ["", *chars]  # class -> character; class 0 is padding
        classes = len(self.char_of)
        self.width = 1 << (classes + 5).bit_length()
        lone = np.full(0x110000, classes, np.int32)  # characters that never merge: their class is their cost
        lone[0x80:], lone[0x800:], lone[0x10000:] = classes + 1, classes + 2, classes + 3
        for p in pieces:
            if len(p) == 1:
                lone[ord(p)] = classes
        for k, c in enumerate(chars):
            lone[ord(c)] = k + 1
        self.class_of, self.first_lone = lone, classes
        beside = np.zeros((classes + 4, classes + 4), bool)
        for p in pieces:
            for a, b in zip(p, p[1:], strict=False):
                beside[lone[ord(a)], lone[ord(b)]] = True
        self.beside = beside
        self.inside = {p[:k] for p in pieces for k in range(1, len(p))}  # proper prefixes
        self.fits: dict[tuple[str, str], bool] = {}
        self._empty()

    def _empty(self) -> None:
        #: (prefix so far, token before it, tokens since) of each unfinished start, by state
        self.states: list[tuple] = [(("", "", 0),), ()]
        self.number: dict[tuple, int] = {self.states[START]: START}
        self.shift = 16
        self.keys, self.to, self.emit, self.used = np.full(1 << 16, -1, np.int64), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int8), 0
        for symbol in range(self.first_lone + 4):
            self._put(IDLE * self.width + symbol, IDLE, 0)
        self._put(START * self.width, START, 0)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.shift)).astype(np.int64)

    def _put(self, key: int, to: int, emit: int) -> None:
        if 2 * self.used >= len(self.keys):
            keys, tos, emits = self.keys, self.to, self.emit
            held = np.flatnonzero(keys >= 0)
            self.shift += 1
            self.keys, self.to, self.emit, self.used = np.full(1 << self.shift, -1, np.int64), np.zeros(1 << self.shift, np.int32), np.zeros(1 << self.shift, np.int8), 0
            for k, t, e in zip(keys[held].tolist(), tos[held].tolist(), emits[held].tolist(), strict=True):
                self._put(k, t, e)
        slot, last = int(self._slots(np.array([key]))[0]), len(self.keys) - 1
        while self.keys[slot] >= 0:
            slot = (slot + 1) & last
        self.keys[slot], self.to[slot], self.emit[slot] = key, to, emit
        self.used += 1

    def _fit(self, before: str, token: str) -> bool:
        """Do the two tokens stay apart when merged as one string?"""
        pair = (before, token)
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) > MOST_TRANSITIONS:
                self.fits.clear()
            self.fits[pair] = known = self.vocabulary.merged(before + token) == [before, token]
        return known

    def _compile(self, state: int, symbol: int) -> tuple[int, int]:
        if symbol >= self.first_lone:
            return START, symbol - self.first_lone + 1
        char, pieces = self.char_of[symbol], self.vocabulary.rank
        live, chosen = [], None
        for prefix, before, since in self.states[state]:
            grown = prefix + char
            if prefix == "" or grown in pieces:
                cost = 1 if grown in pieces else len(char.encode())
                if not before or self._fit(before, grown):
                    if chosen is not None:
                        raise AssertionError(f"two last tokens: {chosen[0]!r}, {grown!r}")
                    chosen = (grown, cost - since)
            if grown in self.inside:
                live.append((grown, before, since))
        if chosen is None:
            raise AssertionError(f"no last token after {self.states[state]!r} and {char!r}")
        token, emit = chosen
        target = (*((p, b, s + emit) for p, b, s in live), ("", token, 0))
        number = self.number.get(target)
        if number is None:
            self.number[target] = number = len(self.states)
            self.states.append(target)
        return number, emit

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted counts, compiling what is missing."""
        key = state * np.int64(self.width) + symbol
        slot, last = self._slots(key), len(self.keys) - 1
        at = self.keys[slot]
        open_ = np.flatnonzero((at != key) & (at >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & last
            at[open_] = self.keys[slot[open_]]
            open_ = open_[(at[open_] != key[open_]) & (at[open_] >= 0)]
        missing = at < 0
        if missing.any():
            for k in np.unique(key[missing]).tolist():
                self._put(k, *self._compile(k // self.width, k % self.width))
            return self.step(state, symbol)
        return self.to[slot], self.emit[slot]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        filled = [i for i, t in enumerate(texts) if t]
        if not filled:
            return out
        if self.used > MOST_TRANSITIONS:
            self._empty()
        codes = np.frombuffer("".join(MARK + texts[i].replace(" ", MARK) for i in filled).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(texts[i]) + 1 for i in filled])
        starts = np.cumsum(sizes) - sizes
        symbols = self.class_of[codes]
        apart = np.ones(len(symbols), bool)
        apart[1:] = ~self.beside[symbols[:-1], symbols[1:]]
        apart[starts] = True
        out[filled] = np.add.reduceat(self._emitted(symbols, apart).astype(np.int64), starts)
        return out

    def _emitted(self, symbols: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """The count that every character emits, chunks side by side."""
        lanes = -(-len(symbols) // CHUNK)
        rows = np.zeros(lanes * CHUNK, np.int32)
        cuts = np.ones(lanes * CHUNK, bool)
        rows[:len(symbols)], cuts[:len(symbols)] = symbols, apart
        rows, cuts = (np.ascontiguousarray(x.reshape(lanes, CHUNK).T) for x in (rows, cuts))
        emitted = np.zeros((CHUNK, lanes), np.int8)
        state = np.full(lanes, IDLE, np.int32)
        for t in range(CHUNK):
            state[cuts[t]] = START
            state, emitted[t] = self.step(state, rows[t])
        head = np.where(cuts.any(axis=0), cuts.argmax(axis=0), CHUNK)
        known = head < CHUNK
        todo = np.flatnonzero(head > 0)
        while len(todo):
            ready = todo[known[todo - 1]]
            order = ready[np.argsort(-head[ready], kind="stable")]
            running, left = state[order - 1].copy(), head[order]
            for t in range(int(left[0])):
                n = int(np.searchsorted(-left, -t, side="left"))
                running[:n], emitted[t, order[:n]] = self.step(running[:n], rows[t, order[:n]])
            whole = order[left == CHUNK]
            state[whole] = running[left == CHUNK]
            known[order] = True
            todo = np.setdiff1d(todo, ready)
        return emitted.T.reshape(-1)[:len(symbols)]


_loaded: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker process, so that tasks share what was compiled."""
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]


def count_tokens(documents: DataFrame, model: str) -> DataFrame:
    """``documents`` with ``n_tokens`` in place of ``text``; other columns stay, an old ``n_tokens`` goes."""
    rest = [f for f in documents.schema if f.name not in ("text", "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = transducer(model)
        for batch in text_batches(batches, "text"):
            counts = counter.counts([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(counts)], names=[*(f.name for f in rest), "n_tokens"])

    return (documents.select(*(F.col(f"`{f.name}`") for f in rest), "text")
            .mapInArrow(run, T.StructType([*rest, T.StructField("n_tokens", T.LongType())])))
