"""Sum-of-squares online packing of tokenised documents into windows.

Each task streams over its documents once.  A document's full windows are cut off; the rest goes where the
sum of squares of the level array (how many open windows there are at each fill level) comes out least: into
an open window of some level, or a new one.  This keeps no level crowded, so that documents of
any size find a window they fill up.

Windows that are still open at the end of a task are closed without loss, since documents may be
cut: the emptiest give their pieces to fill the fullest.  One window stays; it is cut into lengths that
are powers of two, which need no padding.  The same is done when ``most_open`` windows are
open, so a task's memory is bounded by ``most_open`` windows of ids, whatever it reads.

There is no shuffle, so no key can be hot and a lost task packs the same rows again.  Window numbers are the
task's number and a running number.  Null and empty texts are the end token alone; repeated rows are packed each; an
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gradeloom.llm.common import text_batches
from gradeloom.llm.packing import encoder

NAMES = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Piece:
    """Some ids of one document: ``ids`` are its bytes from ``start`` on."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc: object, start: int, ids: bytes, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:4 * at], self.total), Piece(self.doc, self.start + at, self.ids[4 * at:], self.total)


class Packer:
    """Open windows by fill level; closed ones come out of ``closed``."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.levels = np.zeros(capacity + 1, np.int64)                # how many open windows have a level
        self.windows: list[list[list[Piece]]] = [[] for _ in range(capacity)]
        self.closed: list[list[Piece]] = []

    def choose(self, size: int) -> int:
        """The level (0: a new window) after whose growth by ``size`` the squared counts add up to least; the fullest of equals."""
        top = self.capacity - size
        change = 2 * self.levels[size:] + 1                           # the level it grows to gains a window
        change[-1] = 0                                                # a full window leaves the array
        change[1:] -= 2 * self.levels[1:top + 1] - 1                  # the level it grows from loses one
        change[1:][self.levels[1:top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def add(self, doc: object, ids: bytes) -> None:
        total, at, step = len(ids) // 4, 0, self.capacity
        while total - at > step:
            self.closed.append([Piece(doc, at, ids[4 * at:4 * (at + step)], total)])
            at += step
        piece = Piece(doc, at, ids[4 * at:], total)
        level = self.choose(len(piece))
        window = self.windows[level].pop() if level else []
        if level:
            self.levels[level] -= 1
        window.append(piece)
        if level + len(piece) == self.capacity:
            self.closed.append(window)
        else:
            self.windows[level + len(piece)].append(window)
            self.levels[level + len(piece)] += 1
            if not level and self.levels.sum() > self.most_open:
                self.merge()

    def merge(self) -> None:
        """Close windows, fullest first, with the pieces of the emptiest, until one is open."""
        order = [w for level in self.windows for w in level]
        loose: list[Piece] = []
        first, last = 0, len(order) - 1
        while first < last or (loose and first <= last):
            window = order[last]
            last -= 1
            room = self.capacity - sum(map(len, window))
            while room and (loose or first <= last):
                if not loose:
                    loose = order[first]
                    first += 1
                piece = loose.pop()
                if len(piece) > room:
                    piece, rest = piece.cut(room)
                    loose.append(rest)
                window.append(piece)
                room -= len(piece)
            if room:
                loose = window
            else:
                self.closed.append(window)
        if first == last:
            loose = order[first]
        self.windows = [[] for _ in range(self.capacity)]
        self.levels[:] = 0
        if loose:
            level = sum(map(len, loose))
            self.windows[level].append(loose)
            self.levels[level] = 1

    def finish(self) -> None:
        """Close all: the last window in lengths that are powers of two."""
        self.merge()
        for level in np.flatnonzero(self.levels).tolist():
            (window,) = self.windows[level]
            for bit in reversed(range(level.bit_length())):
                if level >> bit & 1:
                    room, own = 1 << bit, []
                    while room:
                        piece = window.pop(0)
                        if len(piece) > room:
                            piece, rest = piece.cut(room)
                            window.insert(0, rest)
                        own.append(piece)
                        room -= len(piece)
                    self.closed.append(own)
        self.windows = [[] for _ in range(self.capacity)]
        self.levels[:] = 0


def pack_documents(documents: DataFrame, tokenizer: str, *, capacity: int = 1024, end_id: int = 0, most_open: int = 4096) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): every id of every document in one piece.

    Windows hold ``capacity`` ids, but for a task's last ones, whose lengths are powers of two.
    """
    schema = T.StructType([documents.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in NAMES)])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        packer = Packer(capacity, most_open)
        number = TaskContext.get().partitionId() << 32

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal number
            docs, columns = [], [[] for _ in NAMES]
            for window in packer.closed:
                offset = 0
                for piece in window:
                    docs.append(piece.doc)
                    for column, value in zip(columns, (piece.start, len(piece), zlib.crc32(piece.ids), piece.total, number, offset), strict=True):
                        column.append(value)
                    offset += len(piece)
                number += 1
            packer.closed = []
            if docs:
                kind = batch_type[0]
                yield pa.RecordBatch.from_arrays([pa.array(docs, kind), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *NAMES])

        batch_type: list[pa.DataType] = []
        for batch in text_batches(batches, "text"):
            batch_type[:] = [batch.column("doc_id").type]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                packer.add(doc, encode(text or "") + end)
            yield from out()
        packer.finish()
        yield from out()

    return documents.select("doc_id", "text").mapInArrow(run, schema)
