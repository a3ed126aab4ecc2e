"""The ordered walk over the possible pairs of a page, for a run of whole pages in a task."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

from pyspark import cloudpickle

from gradeloom.functions.geometry import POS_TOL
from gradeloom.operators.structure import WEAK_PREFIXES

#: Column that says which side a row is of: 0 answer, 1 other.
SIDE = "__side"
#: Proposals looked at together where the order is that of the answer's shapes.
BLOCK = 1 << 20


def _codes(table, names: Sequence[str]):
    """Whether a row differs from the one before in ``names``."""
    import numpy as np

    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in names:
        codes = table[name].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def whole_pages(batches: Iterator, names: Sequence[str]) -> Iterator:
    """Tables of whole pages from batches in which the rows of a page follow one another."""
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        last = int(np.flatnonzero(_codes(held, names))[-1]) if held.num_rows else 0
        if last:
            yield held.slice(0, last).combine_chunks()
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def walk(table, page: Sequence[str], extra: Sequence[str], by_distance: bool, weak_must_meet: bool):
    """(row of the answer, row of the other, place of the key in the answer's keys) of all accepted pairs.

    ``page`` are the columns both sides share, ``extra`` those only the other side has.  By distance, keys go one after
    the other and the nearest pairs first; else the answer's shapes go in page order.  Possible pairs are walked in
    order, and one is accepted if both its ends are free.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = table.num_rows
    column = lambda name: table[name].combine_chunks()
    rank_of = lambda name: pc.rank(column(name), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
    pages = np.cumsum(_codes(table, page)) - 1
    others = column(SIDE).to_numpy(zero_copy_only=False) == 1
    path, z = rank_of("path"), rank_of("z")
    place = {c: column(c) for c in ("cx", "cy", "w", "h")}
    known = {c: v.is_valid().to_numpy(zero_copy_only=False) for c, v in place.items()}
    centred = known["cx"] & known["cy"]
    place = {c: v.fill_null(0).to_numpy(zero_copy_only=False) for c, v in place.items()}
    group = np.zeros(n, np.int64)
    for name in extra:
        codes = column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        group = group * (int(codes.max(initial=0)) + 1) + codes
    groups = int(group.max(initial=0)) + 1

    # one entry for each key of each shape; shapes without a page or a path meet nothing
    keys = column("keys")
    keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
    sizes = pc.list_value_length(keys).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    texts = keys.flatten()
    row = np.repeat(np.arange(n), sizes)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    named = texts.dictionary_encode()
    code = named.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    weak_code = np.array([bool(t) and t.startswith(WEAK_PREFIXES) for t in named.dictionary.to_pylist()] + [False])
    can = column("path").is_valid().to_numpy(zero_copy_only=False)
    for name in page:
        can &= column(name).is_valid().to_numpy(zero_copy_only=False)
    use = can[row] & (code >= 0)
    row, rank, code = row[use], rank[use], code[use]
    meet = pages[row] * (len(named.dictionary) + 1) + code
    ours, theirs = ~others[row], others[row]
    b_meet, b_row = meet[theirs], row[theirs]
    by_meet = np.argsort(b_meet, kind="stable")
    b_meet, b_row = b_meet[by_meet], b_row[by_meet]
    a_row, a_rank, a_code, a_meet = row[ours], rank[ours], code[ours], meet[ours]

    # an end is a path of a page, on the answer's side once for each group of the other
    width = int(path.max(initial=0)) + 1
    end = pages * width + path
    taken_a, taken_b, out = set(), set(), ([], [], [])
    lone = groups == 1

    def accept(at, order: Callable) -> None:
        """Walk the proposals of the answer's entries ``at``."""
        low, high = np.searchsorted(b_meet, a_meet[at], "left"), np.searchsorted(b_meet, a_meet[at], "right")
        many = high - low
        x = np.repeat(at, many)
        y = b_row[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
        a = a_row[x]
        if weak_must_meet:
            apart = lambda c, s: known[c][a] & known[c][y] & known[s][a] & known[s][y] & (
                np.abs(place[c][a] - place[c][y]) * 2 > place[s][a] + place[s][y] + 2 * POS_TOL)
            stand = ~weak_code[a_code[x]] | ~(apart("cx", "w") | apart("cy", "h"))
            x, y, a = x[stand], y[stand], a[stand]
        if by_distance and not lone and taken_a:
            stand = ~np.isin(end[a] * groups + group[y], np.fromiter(taken_a, np.int64, len(taken_a)))
            x, y, a = x[stand], y[stand], a[stand]
        dx, dy = place["cx"][a] - place["cx"][y], place["cy"][a] - place["cy"][y]
        far = np.where(centred[a] & centred[y], dx * dx + dy * dy, 0)
        turn = order(a, y, a_rank[x], far)
        x, y, a = x[turn], y[turn], a[turn]
        for i, j, p, q, r in zip(a.tolist(), y.tolist(), (end[a] * groups + group[y]).tolist(), (end[y] * groups + group[y]).tolist(), a_rank[x].tolist()):
            if p not in taken_a and q not in taken_b:
                taken_a.add(p)
                taken_b.add(q)
                out[0].append(i)
                out[1].append(j)
                out[2].append(r)

    if by_distance:
        for now in range(int(a_rank.max(initial=-1)) + 1):
            at = np.flatnonzero(a_rank == now)
            if taken_a:
                # who is paired needs no more proposals
                if lone:
                    at = at[~np.isin(a_row[at], np.array(out[0]))]
                free = ~np.isin(b_row, np.array(out[1]))
                b_meet, b_row = b_meet[free], b_row[free]
            accept(at, lambda a, y, r, far: np.lexsort((path[y], z[y], path[a], far)))
    else:
        at = np.lexsort((a_rank, path[a_row], z[a_row], pages[a_row]))
        many = np.searchsorted(b_meet, a_meet[at], "right") - np.searchsorted(b_meet, a_meet[at], "left")
        # a shape's own entries stay together
        first = np.flatnonzero(np.r_[True, a_row[at][1:] != a_row[at][:-1]]) if len(at) else np.zeros(0, int)
        block = np.add.reduceat(many, first).cumsum() // BLOCK if len(first) else np.zeros(0, int)
        starts = first[np.flatnonzero(np.r_[True, block[1:] != block[:-1]])] if len(first) else first
        for s, e in zip(starts, [*starts[1:], len(at)]):
            accept(at[s:e], lambda a, y, r, far: np.lexsort((path[y], z[y], far, r, path[a], z[a], pages[a])))
    return tuple(np.array(v, np.int64) for v in out)


def key_at(table, rows, rank):
    """The key at place ``rank`` of the keys of ``rows``; none where the place is below zero."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    keys = table["keys"].combine_chunks()
    keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
    sizes = pc.list_value_length(keys).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return keys.flatten().take(pa.array((np.cumsum(sizes) - sizes)[rows] + rank, mask=rank < 0))


def paired_tables(page: Sequence[str], extra: Sequence[str], by_distance: bool, weak_must_meet: bool, made: Callable) -> Callable:
    """A task: ``made(table, answer rows, other rows, key ranks)`` for each run of whole pages."""

    def task(batches):
        for table in whole_pages(batches, page):
            yield from made(table, *walk(table, page, extra, by_distance, weak_must_meet)).to_batches(max_chunksize=10_000)

    return task


# tasks get these functions with the job, wherever the package is installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
