"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints within ``within`` differing bits are found without comparing all pairs: the bits are put
into parts, correlated bits together, and part i gets its own threshold t(i) with
sum(t(i) + 1) > within, so two linked fingerprints agree on some part up to its threshold.  Parts and
thresholds come from dynamic programming over estimated costs: rows to probe, plus candidates by the
distance counts that all fingerprints show in each block of bits.  Every fingerprint emits its part
values and, where t(i) > 0, the values around them; rows that meet are verified over all bits.

A bucket is split into blocks of ``BLOCK`` rows and every pair of blocks is one unit of work, so a
value shared by a third of all rows is not one task, and of the links inside a unit only a spanning
forest leaves it: connectivity is kept, the pairs of a large group are never emitted.  Where links are then
verified by another measure, a forest whose links fail says nothing about its other pairs: all pairs of
such a group that are not connected yet are verified where they meet, and a forest of those that hold leaves.

Words are the maximal runs of characters other than blank and tab to carriage return, with A-Z lower-cased.
A text of fewer words than a shingle has its whole word sequence as its only shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import boxed, components, text_batches, written

SEED = 42
BLOCK = 2048
#: Relative costs: one probed row is generated, shuffled and sorted; one candidate is an xor in an array.
PROBE_COST, CANDIDATE_COST = 1.0, 0.005
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(LOWER).split()


def shingle_hashes(words: list[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included."""
    if not words:
        return np.zeros(0, np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if size == 1:
        return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))
    if len(words) < size:
        return np.array([digest(join(words), seed)], np.uint64)
    runs = zip(*(words[i:] for i in range(size)), strict=False)
    return np.fromiter((digest(join(run), seed) for run in runs), np.uint64, len(words) - size + 1)


def fingerprint(hashes: np.ndarray, bits: int = 64) -> bytes:
    """Bit k is set if it is set in over half of the hashes; big-endian bytes.

    Beyond 64 bits every hash is stretched by multiplication with fixed odd numbers.  No hash: zero.
    """
    if not len(hashes):
        return bytes(bits // 8)
    out = []
    for word in range(bits // 64):
        with np.errstate(over="ignore"):
            h = hashes if word == 0 else _mixed(hashes, word)
        total = np.zeros(64, np.int64)
        for start in range(0, len(h), 1 << 16):
            total += np.unpackbits(h[start:start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(total * 2 > len(h)).tobytes())
    return b"".join(out)


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    x = (h ^ np.uint64(word * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(29))


def fingerprints(documents: DataFrame, *, shingle: int = 3, bits: int = 64, distinct: bool = False) -> DataFrame:
    """``documents`` with ``text`` replaced by ``fp`` (binary).  Null and empty texts get zero."""
    rest = [f for f in documents.schema if f.name not in ("text", "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            found = []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(words_of(text), shingle)
                found.append(fingerprint(np.unique(hashes) if distinct else hashes, bits))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(found, pa.binary())], names=[*(f.name for f in rest), "fp"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)
    return documents.select(*(f"`{f.name}`" for f in rest), "text").mapInArrow(run, f"{schema}fp binary")


def matrix(column: pa.Array, bits: int) -> np.ndarray:
    """A binary column of equal widths as rows of big-endian bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, bits // 8)


# ---------------------------------------------------------------- plan of parts

@dataclass(frozen=True)
class Part:
    """Bit positions of one part and the differing bits allowed in it; -1: the part isn't probed."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def probes(self) -> int:
        return 0 if self.threshold < 0 else sum(1 for e in range(self.threshold + 1) for _ in combinations(self.bits, e))


def bit_counts(prints: DataFrame, bits: int) -> np.ndarray:
    """How often bits i and j are both set, over all fingerprints (bits x bits numbers reach the driver)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((bits, bits))
        for batch in batches:
            x = np.unpackbits(matrix(batch.column("fp"), bits), axis=1).astype(np.float32)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(bits * bits), pa.int32()), pa.array(total.astype(np.int64).ravel())], ["cell", "n"])

    rows = prints.select("fp").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(bits * bits)
    out[rows["cell"]] = rows["n"]
    return out.reshape(bits, bits)


def grouped_bits(both: np.ndarray, n: int, widths: list[int]) -> list[tuple[int, ...]]:
    """Greedy blocks of the given widths: each takes the free bits most correlated with what it holds."""
    share = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tie = np.abs(both / max(1, n) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    free, blocks = set(range(len(share))), []
    for width in widths:
        order = sorted(free)
        first = max(order, key=lambda b: (tie[b, order].sum(), -b))
        block, pull = [first], tie[first].copy()
        free.remove(first)
        while len(block) < width:
            take = max(sorted(free), key=lambda b: pull[b])
            block.append(take)
            free.remove(take)
            pull += tie[take]
        blocks.append(tuple(sorted(block)))
    return blocks


def values_of(rows: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    """The bits at ``positions`` of each fingerprint as one number."""
    out = np.zeros(len(rows), np.uint64)
    for p in positions:
        out = (out << np.uint64(1)) | ((rows[:, p // 8] >> np.uint8(7 - p % 8)) & np.uint8(1)).astype(np.uint64)
    return out


def distance_shares(prints: DataFrame, bits: int, blocks: list[tuple[int, ...]]) -> list[np.ndarray]:
    """Per block: the share of ordered pairs of fingerprints at each distance within the block.

    From the counts of all block values (at most blocks x 2^width numbers), by XOR convolution.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1 << len(b), np.int64) for b in blocks]
        for batch in batches:
            rows = matrix(batch.column("fp"), bits)
            for i, b in enumerate(blocks):
                total[i] += np.bincount(values_of(rows, b).astype(np.int64), minlength=len(total[i]))
        for i, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i), pa.int32()), pa.array(at, pa.int64()), pa.array(t[at], pa.int64())], ["block", "value", "n"])

    rows = (prints.select("fp").mapInArrow(count, "block int, value long, n long")
            .groupBy("block", "value").agg(F.sum("n").alias("n")).toPandas())
    out = []
    for i, b in enumerate(blocks):
        own = rows[rows["block"] == i]
        x = np.zeros(1 << len(b))
        x[own["value"]] = own["n"]
        total = max(1.0, x.sum())
        turned = _hadamard(x) ** 2
        pairs = _hadamard(turned) / len(x)
        out.append(np.bincount(np.bitwise_count(np.arange(len(x), dtype=np.uint64)), weights=np.maximum(pairs, 0), minlength=len(b) + 1) / total ** 2)
    return out


def _hadamard(x: np.ndarray) -> np.ndarray:
    x, step = x.copy(), 1
    while step < len(x):
        y = x.reshape(-1, 2, step)
        x = np.stack([y[:, 0] + y[:, 1], y[:, 0] - y[:, 1]], axis=1).reshape(-1)
        step *= 2
    return x


def allocated(n: int, within: int, blocks: list[tuple[int, ...]], shares: list[np.ndarray], most: int = 3, together: int | None = None) -> list[Part]:
    """The cheapest parts and thresholds whose sum of t + 1 exceeds ``within``.

    A part is a run of ``together`` blocks, or of as many as are cheapest, up to 63 bits.
    """
    best: tuple[float, list[Part]] | None = None
    for run in [together] if together else range(1, len(blocks) + 1):
        parts = [sum(blocks[i:i + run], ()) for i in range(0, len(blocks), run)]
        if max(map(len, parts)) > 63:
            break
        spread = []
        for i in range(0, len(blocks), run):
            total = np.ones(1)
            for s in shares[i:i + run]:
                total = np.convolve(total, s)
            spread.append(total)
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for part, share in zip(parts, spread, strict=True):
            grown: dict[int, tuple[float, tuple[int, ...]]] = {}
            for t in range(-1, most + 1):
                probes = Part(part, t).probes
                if probes > 6000:
                    break
                cost = 0.0 if t < 0 else PROBE_COST * n * (probes + (t > 0)) + CANDIDATE_COST * n * n * float(share[:t + 1].sum())
                for have, (spent, chosen) in table.items():
                    key = min(within + 1, have + t + 1)
                    if key not in grown or spent + cost < grown[key][0]:
                        grown[key] = (spent + cost, (*chosen, t))
            table = grown
        if within + 1 in table and (best is None or table[within + 1][0] < best[0]):
            best = (table[within + 1][0], [Part(tuple(sorted(p)), t) for p, t in zip(parts, table[within + 1][1], strict=True)])
    if best is None:
        raise ValueError(f"no allocation finds {within} differing bits")
    return best[1]


def crossed(parts: list[Part]) -> list[Part]:
    """As many parts over the same bits once more, each with bits from as many of the given parts as can be."""
    order = [p.bits[i] for i in range(max(len(p.bits) for p in parts)) for p in parts if i < len(p.bits)]
    ends = np.cumsum([len(p.bits) for p in parts]).tolist()
    return [Part(tuple(sorted(order[lo:hi])), 0) for lo, hi in zip([0, *ends], ends, strict=False)]


def plan_parts(prints: DataFrame, *, bits: int, within: int, block_bits: int = 16, together: int | None = None) -> list[Part]:
    n = prints.count()
    count = -(-bits // block_bits)
    widths = [bits // count + (i < bits % count) for i in range(count)]
    blocks = grouped_bits(bit_counts(prints, bits), n, widths)
    return allocated(n, within, blocks, distance_shares(prints, bits, blocks), together=together)


# ---------------------------------------------------------------- probing and verifying

def probes(prints: DataFrame, parts: list[Part], bits: int, carried: int) -> DataFrame:
    """(part, value, node, seed, fp): one row per fingerprint, part and value within the part's threshold.

    ``fp`` is the first ``carried`` bits, ``seed`` the group that the node is known to be in (null: none).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("fp"), bits)
            carry = pa.array([r.tobytes() for r in rows[:, :carried // 8]], pa.binary())
            for i, part in enumerate(parts):
                if part.threshold < 0:
                    continue
                exact, width = values_of(rows, part.bits), len(part.bits)
                for e in range(part.threshold + 1):
                    for flips in combinations(range(width), e):
                        mask = np.uint64(sum(1 << f for f in flips))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(exact), i), pa.int32()), pa.array((exact ^ mask).astype(np.int64)), batch.column("node"), batch.column("seed"), carry],
                            ["part", "value", "node", "seed", "fp"])

    seed = F.col("seed") if "seed" in prints.columns else F.lit(None)
    return prints.select("node", seed.cast("long").alias("seed"), "fp").mapInArrow(run, "part int, value long, node long, seed long, fp binary")


def paired_blocks(rows: DataFrame, keys: list[str], sizes: DataFrame) -> DataFrame:
    """``rows`` copied to the units (x, y) of their key in which every pair but those of two majors meets.

    ``sizes`` has the ``keys`` of too many rows for one unit, with their ``majors`` and ``minors``.  Blocks of minors meet
    each other and all blocks of majors; majors never meet, so a key whose rows are nearly all majors costs a copy or two a row.
    """
    of_majors, of_minors = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("majors", "minors"))
    rows = (rows.join(sizes.select(*keys, of_majors.alias("_b"), of_minors.alias("_s")), keys, "left")
            .where("_s is null or _s > 0 or not major"))
    home = F.when(F.col("major"), F.col("_s") + F.pmod(F.xxhash64("node"), F.col("_b"))).otherwise(F.pmod(F.xxhash64("node"), F.col("_s")))
    last = F.when(F.col("major"), F.col("_s") - 1).otherwise(F.col("_b") + F.col("_s") - 1)
    other = F.explode(F.sequence(F.lit(0), F.coalesce(last, F.lit(0))))
    return (rows.withColumn("_home", F.coalesce(home, F.lit(0)).cast("int")).withColumn("_other", other)
            .withColumn("x", F.least("_home", "_other")).withColumn("y", F.greatest("_home", "_other")).drop("_b", "_s", "_home", "_other"))


def _forest(keys: np.ndarray, nodes: np.ndarray, rows: np.ndarray, within: int, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows at the ends of the links of a spanning forest, closest pairs first, of rows with equal keys (sorted)
    within the distance, and for every link the smallest node of its tree.  Rows of equal seeds are connected beforehand."""
    n = len(keys)
    order = np.lexsort((seeds, keys))
    starts = np.append(True, (keys[order][1:] != keys[order][:-1]) | (seeds[order][1:] != seeds[order][:-1]))
    root = np.empty(n, np.int64)
    root[order] = order[np.flatnonzero(starts)][np.cumsum(starts) - 1]
    wide = np.ascontiguousarray(rows).view(np.uint64)
    size_after = np.zeros(n, np.int64)  # rows of the same key that follow
    ends = np.flatnonzero(np.append(keys[1:] != keys[:-1], True))
    starts = np.append(0, ends[:-1] + 1)
    size_after = np.repeat(ends, ends - starts + 1) - np.arange(n)
    left, right, far = [], [], []
    alive, step = np.flatnonzero(size_after >= 1), 1
    while len(alive):
        apart = np.bitwise_count(wide[alive] ^ wide[alive + step]).sum(axis=1, dtype=np.int32)
        hit = apart <= within
        left.append(alive[hit])
        right.append(alive[hit] + step)
        far.append(apart[hit])
        step += 1
        alive = alive[size_after[alive] >= step]
    none = np.zeros(0, np.int64)
    if not left:
        return none, none, none
    a, b, d = np.concatenate(left), np.concatenate(right), np.concatenate(far)
    other = (nodes[a] != nodes[b]) & (root[a] != root[b])
    a, b, d = a[other], b[other], d[other]
    used = np.zeros(len(a), bool)
    for level in np.unique(d):
        at = np.flatnonzero(d == level)
        while True:
            at = at[root[a[at]] != root[b[at]]]
            if not len(at):
                break
            # each root takes one link to a smaller root; the rest is looked at again
            x, y = root[a[at]], root[b[at]]
            _, first = np.unique(np.maximum(x, y), return_index=True)
            used[at[first]] = True
            root[np.maximum(x, y)[first]] = np.minimum(x, y)[first]
            while (root != root[root]).any():
                root = root[root]
    least = nodes.copy()
    np.minimum.at(least, root, nodes)
    return a[used], b[used], least[root[a[used]]]


def links(prints: DataFrame, *, bits: int, within: int, verify: int | None = None, block_bits: int = 16,
          together: int | None = None, carried: int | None = None, parts: list[Part] | None = None, across: bool = True, grouped: bool = False) -> DataFrame:
    """(a, b): links that connect what fingerprints within the distance connect.

    ``prints`` has ``node`` (long, unique) and ``fp`` (binary).  ``within`` is the distance up to which
    every pair is sure to be found, ``verify`` (``within`` if not given) the largest one accepted among
    the first ``carried`` bits (all, if not given).  Other ``parts`` to agree on can be given.  Nodes of an equal ``seed``
    (long, null: none) are connected already: they are not linked, and in buckets of more than ``BLOCK`` rows those of the
    most frequent seed are not even compared.  Without ``across``, the blocks of such buckets are linked each by itself.
    A caller that goes on to reject links by another measure asks for ``grouped`` links: ``tree`` names the tree of a
    unit that a link is part of, and all pairs of that unit within the distance are pairs of nodes of one tree, or of
    nodes with the seeds of its nodes.
    """
    parts = parts or plan_parts(prints, bits=bits, within=within, block_bits=block_bits, together=together)
    verify, carried = within if verify is None else verify, carried or bits
    rows = probes(prints, parts, bits, carried)
    hot = written(rows.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "hot-buckets")
    few = hot.count() <= 100_000
    if across and "seed" in prints.columns:
        seeds = rows.where("seed is not null").join(F.broadcast(hot) if few else hot, ["part", "value"]).groupBy("part", "value", "seed").agg(F.count("*").alias("m"))
        most = seeds.groupBy("part", "value").agg(F.max_by("seed", F.struct("m", "seed")).alias("_seed"), F.max("m").alias("_m"))
        hot = hot.join(most, ["part", "value"], "left")
        hot = written(hot.select("part", "value", "_seed", F.coalesce("_m", F.lit(0)).alias("majors"), (F.col("n") - F.coalesce("_m", F.lit(0))).alias("minors")), "hot-seeds")
    else:
        hot = hot.select("part", "value", F.lit(None).cast("long").alias("_seed"), F.lit(0).cast("long").alias("majors"), F.col("n").alias("minors"))
    if few:
        hot = F.broadcast(hot)
    keys = ["part", "value"]
    if across:
        marked = rows.join(hot.select(*keys, "_seed"), keys, "left").withColumn("major", F.coalesce(F.col("seed") == F.col("_seed"), F.lit(False)))
        units = paired_blocks(marked, keys, hot)
    else:
        blocks = F.ceil(F.col("minors") / BLOCK)
        own = F.coalesce(F.pmod(F.xxhash64("node"), blocks), F.lit(0)).cast("int")
        units = rows.join(hot, keys, "left").withColumn("x", own).withColumn("y", F.col("x"))
    units = units.select("part", "value", "x", "y", "node", F.coalesce("seed", "node").alias("seed"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nodes = table.column("node").to_numpy()
            fps = matrix(table.column("fp").combine_chunks(), carried)
            change = np.zeros(len(nodes), bool)
            for c in ("part", "value", "x", "y"):
                v = table.column(c).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            keys = np.cumsum(change)
            size = np.bincount(keys)
            keep = size[keys] > 1
            unit = np.zeros(len(keys), np.uint64)
            with np.errstate(over="ignore"):
                for c in ("part", "value", "x", "y") if grouped else ():
                    unit = _mixed(unit + table.column(c).to_numpy().astype(np.int64).view(np.uint64), 1)
            keys, nodes, fps, unit, seeds = keys[keep], nodes[keep], fps[keep], unit[keep], table.column("seed").to_numpy()[keep]
            if not len(keys):
                return
            _, keys, counts = np.unique(keys, return_inverse=True, return_counts=True)
            slot = np.cumsum(counts.astype(np.int64) ** 2) // 4_000_000
            bounds = np.searchsorted(slot[keys], np.unique(slot))
            for lo, hi in zip(bounds, np.append(bounds[1:], len(keys)), strict=True):
                a, b, least = _forest(keys[lo:hi], nodes[lo:hi], fps[lo:hi], verify, seeds[lo:hi])
                if not len(a):
                    continue
                ends = [pa.array(nodes[lo:hi][a]), pa.array(nodes[lo:hi][b])]
                with np.errstate(over="ignore"):
                    tree = _mixed(unit[lo:hi][a] + least.view(np.uint64), 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([*ends, pa.array(tree)] if grouped else ends, ["a", "b", "tree"] if grouped else ["a", "b"])

        def last_start(batch: pa.RecordBatch) -> int:
            """Where the last unit of the batch begins."""
            change = np.zeros(batch.num_rows, bool)
            for c in ("part", "value", "x", "y"):
                v = batch.column(c).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            at = np.flatnonzero(change)
            return int(at[-1]) if len(at) else 0

        for batch in batches:
            if not batch.num_rows:
                continue
            cut = last_start(batch)
            if held:
                before = held[-1].slice(held[-1].num_rows - 1)
                same = all(before.column(c)[0] == batch.column(c)[0] for c in ("part", "value", "x", "y"))
                if not same or cut:
                    head = [*held, batch.slice(0, cut)] if same or cut else held
                    yield from found(pa.Table.from_batches(head))
                    held = [batch.slice(cut)] if same or cut else [batch]
                    continue
            elif cut:
                yield from found(pa.Table.from_batches([batch.slice(0, cut)]))
                held = [batch.slice(cut)]
                continue
            held.append(batch)
        if held:
            yield from found(pa.Table.from_batches(held))

    return (units.repartition("part", "value", "x", "y").sortWithinPartitions("part", "value", "x", "y")
            .mapInArrow(run, "a long, b long, tree long" if grouped else "a long, b long"))


def _set_links(root: np.ndarray, rows: np.ndarray, sets: list[np.ndarray], within: int, least: float) -> list[tuple[int, int]]:
    """A forest of the pairs of different roots, within the distance and of a Jaccard similarity of ``least``."""
    root, out = root.copy(), []
    size = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ranks = np.split(flat, np.cumsum(size)[:-1])
    held = np.zeros(len(flat), bool)
    wide = np.ascontiguousarray(rows).view(np.uint64)
    for i in range(len(sets) - 1):
        far = np.bitwise_count(wide[i + 1:] ^ wide[i]).sum(axis=1, dtype=np.int32)
        small, large = np.minimum(size[i + 1:], size[i]), np.maximum(size[i + 1:], size[i])
        at = i + 1 + np.flatnonzero((root[i + 1:] != root[i]) & (far <= within) & (small > 0) & (small >= least * large))
        held[ranks[i]] = True
        while len(at):
            now, at = at[:256], at[256:]
            ends = np.cumsum(size[now])
            shared = np.add.reduceat(held[np.concatenate([ranks[j] for j in now])], np.append(0, ends[:-1]), dtype=np.int64)
            for j in now[(shared > 0) & (shared >= least * (size[i] + size[now] - shared))].tolist():
                if root[j] != root[i]:
                    out.append((i, j))
                    root[root == root[j]] = root[i]
            at = at[root[at] != root[i]]
        held[ranks[i]] = False
    return out


def set_links(members: DataFrame, *, within: int, least: float, carried: int) -> DataFrame:
    """(a, b): links that connect, with the components there are, all pairs of a tree that hold.

    ``members`` has ``tree``, ``node``, ``component``, ``fp`` (``carried`` bits) and ``shingles``; a pair holds if it is
    within the distance and its sets have a Jaccard similarity of ``least`` or more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
            node = table.column("node").to_numpy()
            sets = [s.values.to_numpy() for s in table.column("shingles")]
            pairs = _set_links(table.column("component").to_numpy(), matrix(table.column("fp").combine_chunks(), carried), sets, within, least)
            if pairs:
                a, b = (node[list(e)] for e in zip(*pairs, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            tree = batch.column("tree").to_numpy()
            starts = [0, *(np.flatnonzero(tree[1:] != tree[:-1]) + 1).tolist(), len(tree)]
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if hi > lo:
                    if held and held[-1].column("tree")[0].as_py() != tree[lo]:
                        yield from found(pa.Table.from_batches(held))
                        held = []
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from found(pa.Table.from_batches(held))

    return (members.select("tree", "node", "component", "fp", "shingles").repartition("tree").sortWithinPartitions("tree")
            .mapInArrow(run, "a long, b long"))


# ---------------------------------------------------------------- operators

def near_duplicates(documents: DataFrame, *, shingle: int = 3, within: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): groups of fingerprints that chains of links connect.

    Exact copies and texts of equal fingerprints are one node.  ``component_id`` is the smallest id
    of the group, null if all its ids are null; repeated rows stay rows.
    """
    prints = written(fingerprints(documents.select("doc_id", "text"), shingle=shingle), "fingerprints")
    word = F.conv(F.hex("fp"), 16, -10).cast("long")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("node", word), "classes")
    joined = components(links(classes, bits=64, within=within))
    labelled = classes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(smallest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of ``texts(node, text)``: the distinct shingles as sorted 32-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            sets = [np.unique(shingle_hashes(words_of(t), shingle).astype(np.uint32).view(np.int32)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int32()))], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles array<int>")


def rivals(trees: DataFrame, joined: DataFrame, classes: DataFrame, sets: DataFrame, carried: int) -> DataFrame:
    """Members of the groups that meet in ``trees(a, b, tree)``, as ``set_links`` reads them.

    The largest group of a tree is its major, and the others are compared with it and with each other.  Trees of one
    major are one, so what several trees ask of the same groups is done once.
    """
    nodes = trees.select("tree", F.col("a").alias("node")).union(trees.select("tree", "b")).distinct()
    sizes = joined.groupBy("component").agg(F.count("*").alias("_n"))
    groups = written(nodes.join(joined, "node", "left").select("tree", F.coalesce("component", "node").alias("component")).distinct()
                     .join(sizes, "component", "left").withColumn("_n", F.coalesce("_n", F.lit(1))), "tree-groups")
    major = groups.groupBy("tree").agg(F.max_by("component", F.struct("_n", "component")).alias("top"))
    minors = written(groups.join(major, "tree").where("component <> top").select("top", "component").distinct(), "rivals")
    asked = (minors.withColumn("major", F.lit(False))
             .unionByName(minors.select("top", F.col("top").alias("component")).distinct().withColumn("major", F.lit(True))))
    members = written(asked.join(joined, "component", "left").select("top", "component", "major", F.coalesce("node", "component").alias("node")), "rival-members")
    large = (members.groupBy("top").agg(F.count_if("major").alias("majors"), F.count_if(~F.col("major")).alias("minors"))
             .where(F.col("majors") + F.col("minors") > BLOCK))
    units = paired_blocks(members, ["top"], large).select(F.xxhash64("top", "x", "y").alias("tree"), "component", "node")
    return (units.join(classes.select("node", F.substring("fp", 1, carried // 8).alias("fp")), "node").join(sets, "node"))


def one_of_each_group(documents: DataFrame, *, shingle: int = 5, least: float = 0.8, bits: int = 512, within: int = 36,
                      block_bits: int = 7, together: int = 2, carried: int = 128, candidate_share: float = 0.3, seed_parts: int = 8) -> DataFrame:
    """``documents`` with one row of every group of near copies, in their own columns.

    Exact copies are one node.  Nodes are linked if their sets of ``shingle``-word runs have a Jaccard
    similarity of ``least`` or more; candidates come from SimHash over the same sets: any pair within
    ``within`` bits is a candidate, and so is any that agrees on a part and differs in at most
    ``candidate_share`` of the first ``carried`` bits.  Every candidate is verified, or joined by others that
    were.  Two sets of similarity 0.8 are at an angle of at most arccos(8/9), so about 15 % of the bits
    differ, whether words were edited here and there or a passage was added, cut or replaced (over distinct
    words the angle would depend on the edit).  At 15 %, a part of 14 bits is equal with a chance of 10 %:
    the bits are put into 37 parts of 13 or 14 bits, and into 37 others across these.
    Some parts go first, block by block, and what they link is one group before all parts are probed: a large group of near
    copies then costs rows in proportion to its size.  Where a candidate fails between two groups, all members of the
    one are compared with all members of the other.
    Of a group, the row with the smallest ``doc_id`` stays (nulls last); of repeated rows, one.
    Null texts are copies of one another, and texts without words are linked by equality only.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    digest = F.unhex(F.coalesce(F.md5("text"), F.lit("00")))
    marked = documents.select("doc_id", "text").withColumn("digest", digest)
    prints = fingerprints(marked, shingle=shingle, bits=bits, distinct=True)
    classes = written(prints.groupBy("digest").agg(F.min(key).alias("first"), F.any_value("fp").alias("fp"))
                      .withColumn("node", F.monotonically_increasing_id()), "classes")
    texts = documents.select("doc_id", "text", digest.alias("_digest"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, "node").select("node", F.col("digest").alias("_d"), F.col("first.id").alias("_id"))
        own = texts.join(wanted, texts["_digest"].eqNullSafe(wanted["_d"]) & texts["doc_id"].eqNullSafe(wanted["_id"]))
        return written(shingle_sets(own, shingle).dropDuplicates(["node"]), "shingle-sets")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left, right = (sets.select(F.col("node").alias(e), F.col("shingles").alias(f"s{e}")) for e in "ab")
        shared = F.size(F.array_intersect("sa", "sb"))
        return written(pairs.join(left, "a").join(right, "b")
                       .where((shared > 0) & (shared >= least * (F.size("sa") + F.size("sb") - shared))).select("a", "b"), "links")

    parts = plan_parts(classes, bits=bits, within=within, block_bits=block_bits, together=together)
    how = {"bits": bits, "within": within, "verify": int(candidate_share * carried), "carried": carried}
    pairs = written(links(classes, parts=parts[:seed_parts], across=False, **how).distinct(), "seed-pairs")
    sets = sets_of(ends(pairs))
    linked = verified(pairs, sets)
    seeds = components(linked).withColumnRenamed("component", "seed")
    seeded = written(classes.select("node", "fp").join(seeds, "node", "left"), "seeded")
    found = written(links(seeded, parts=parts + crossed(parts), grouped=True, **how), "candidates")
    pairs = written(found.select("a", "b").distinct(), "pairs")
    sets = sets.unionByName(sets_of(ends(pairs).join(sets, "node", "left_anti")))
    linked = linked.unionByName(verified(pairs, sets))
    joined = written(components(linked), "groups")
    one, two = (joined.select(F.col("node").alias(e), F.col("component").alias(f"c{e}")) for e in "ab")
    broken = written(pairs.join(one, "a", "left").join(two, "b", "left")
                     .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "broken")
    if not broken.isEmpty():
        trees = written(found.join(found.join(broken, ["a", "b"]).select("tree").distinct(), "tree"), "broken-trees")
        more = written(set_links(rivals(trees, joined, classes, sets, carried), within=how["verify"], least=least, carried=carried), "more-links")
        joined = components(linked.unionByName(more))
    kept = (classes.join(joined, "node", "left").groupBy(F.coalesce("component", "node").alias("component"))
            .agg(F.min_by(F.struct(F.col("digest").alias("_d"), F.col("first.id").alias("_id")), F.struct("first", "node")).alias("k")).select("k.*"))
    held = documents.select(boxed(documents).alias("_row"), digest.alias("_digest"), F.col("doc_id").alias("_doc"))
    chosen = held.join(kept, (F.col("_digest") == F.col("_d")) & F.col("_doc").eqNullSafe(F.col("_id")))
    alone = chosen.withColumn("_n", F.row_number().over(Window.partitionBy("_digest", "_id").orderBy("_digest")))
    return alone.where("_n = 1").select("_row.*")
