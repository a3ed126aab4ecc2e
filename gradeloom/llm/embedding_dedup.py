"""Embedding near-dedup with a robust-pruned flat graph.

Distinct vectors are dealt over overlapping cluster shards (centroids fitted on a bounded sample,
every vector indexed).  Each shard builds a flat graph: nearest neighbours, robust-pruned, with reverse
edges; the adjacency lists of a vector from all its shards are united.  Every vector is a query in its
nearest shards: greedy search from the shard's medoids (and its own node), then expansion over all
neighbours while they stay in range; cosines of what is found are verified in double precision.  A
neighbour is counted in its home shard only, so overlaps count once.  Recall is audited against
brute force for a fixed number of queries over all vectors, and the search is widened until it suffices.

Shards with more than ``most_home`` home vectors are split by hash and queries go to every part; the queries of a
shard are split by another hash into blocks of about ``most_asked``, so a task holds one part and one block however many
vectors a cluster has.  Only counts and a spanning forest of the links leave a task, never all pairs of a group, and
the links of 256 queries are held at a time.

Vectors that are null, zero, hold null or non-finite components, or have another length than most link
with nothing.  Equal vectors are one node with a weight; repeated rows are rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import components, written


def unit(blobs) -> np.ndarray:
    """Stored single-precision vectors as rows of length one in double precision."""
    rows = np.frombuffer(b"".join(blobs), np.float32).astype(np.float64)
    rows = rows.reshape(len(blobs), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the links (a, b) between nodes 0 to n - 1."""
    root, took = np.arange(n), []
    at = np.arange(len(a))
    while True:
        x, y = root[a[at]], root[b[at]]
        at = at[x != y]
        if not len(at):
            break
        x, y = root[a[at]], root[b[at]]
        _, first = np.unique(np.maximum(x, y), return_index=True)
        took.append(at[first])
        root[np.maximum(x, y)[first]] = np.minimum(x, y)[first]
        while (root != root[root]).any():
            root = root[root]
    took = np.concatenate(took) if took else np.zeros(0, np.int64)
    return a[took], b[took]


def centroids_of(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of the sample."""
    rng = np.random.default_rng(7)
    centres = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(size > 0, total / np.maximum(size, 1e-12), centres)
    return centres


def pruned_graph(rows: np.ndarray, *, degree: int, nearest: int, pool: int, alpha: float) -> list[np.ndarray]:
    """Robust-pruned neighbours of each row, with its ``nearest`` ones kept and reverse edges added."""
    n = len(rows)
    pool = min(pool, n - 1)
    if pool <= 0:
        return [np.zeros(0, np.int64) for _ in range(n)]
    small = rows.astype(np.float32)
    ahead: list[np.ndarray] = []
    for lo in range(0, n, 512):
        near = small[lo:lo + 512] @ small.T
        near[np.arange(len(near)), np.arange(lo, lo + len(near))] = -2
        part = np.argpartition(-near, pool - 1, axis=1)[:, :pool]
        close = np.take_along_axis(near, part, axis=1)
        order = np.argsort(-close, axis=1, kind="stable")
        part, close = np.take_along_axis(part, order, axis=1), np.take_along_axis(close, order, axis=1)
        among = np.einsum("ipd,iqd->ipq", small[part], small[part])
        # distances on the unit sphere: 2 - 2 cos; a candidate goes if alpha * d(kept, it) <= d(row, it)
        covered, kept = np.zeros(part.shape, bool), np.zeros(part.shape, bool)
        for p in range(pool):
            take = ~covered[:, p] & (kept.sum(axis=1) < degree)
            kept[:, p] = take
            covered |= take[:, None] & (alpha * (2 - 2 * among[:, p, :]) <= 2 - 2 * close)
        kept[:, :nearest] = True
        ahead.extend(part[i][kept[i]] for i in range(len(part)))
    tail = np.repeat(np.arange(n), [len(x) for x in ahead])
    head = np.concatenate(ahead)
    both = np.unique(np.concatenate([tail * n + head, head * n + tail]))
    return np.split(both % n, np.searchsorted(both // n, np.arange(1, n)))


def medoids_of(rows: np.ndarray, count: int) -> np.ndarray:
    """The rows closest to the mean and to a few centres."""
    centres = [rows.mean(axis=0)]
    if len(rows) > 4 * count:
        centres.extend(centroids_of(rows[:: max(1, len(rows) // 2048)], count, rounds=3))
    return np.unique((np.stack(centres) @ rows.T).argmax(axis=1))


def range_search(rows: np.ndarray, lists: list[np.ndarray], entries: np.ndarray, queries: np.ndarray, own: np.ndarray, *,
                 least: float, beam: int, steps: int = 96) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) pairs in range, some queries at a time.  ``lists``: neighbours of each row; ``own``: the query's row or -1.

    A greedy step looks at up to ``steps`` neighbours of a row, the expansion in range at all of them.
    """
    graph = padded([x if len(x) <= steps else x[np.linspace(0, len(x) - 1, steps).astype(int)] for x in lists])
    degree = np.array([len(x) for x in lists], np.int64)
    begin, heads = np.cumsum(degree) - degree, np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
    small, asked = rows.astype(np.float32), queries.astype(np.float32)
    n, m = len(rows), 256
    for lo in range(0, len(queries), m):
        q, mine = asked[lo:lo + m], own[lo:lo + m]
        size = len(q)
        line = np.arange(size)
        seen = np.zeros((size, n + 1), bool)  # the last column stands for no neighbour
        seen[:, n] = True
        start = np.concatenate([np.repeat(entries[None, :], size, axis=0), np.where(mine >= 0, mine, n)[:, None]], axis=1)
        hits: list[tuple[np.ndarray, np.ndarray]] = []

        def look(at: np.ndarray, q=q, seen=seen, hits=hits, line=line) -> np.ndarray:
            """Similarities of unseen rows, -2 for seen ones; those in range are noted."""
            at = np.where(at < 0, n, at)
            fresh = ~np.take_along_axis(seen, at, axis=1)
            ordered = np.sort(at, axis=1)
            near = np.full(at.shape, -2, np.float32)
            i, j = np.nonzero(fresh)
            near[i, j] = np.einsum("pd,pd->p", q[i], small[at[i, j]])
            seen[line[:, None], ordered] = True
            close = near[i, j] >= least - 1e-4
            hits.append((i[close], at[i, j][close]))
            return near

        near = look(start)
        ids, open_ = np.where(start < n, start, 0), near > -2
        for _ in range(4 * beam):
            rank = np.where(open_, near, -3)
            best = rank.argmax(axis=1)
            go = rank[line, best] > -2
            if not go.any():
                break
            open_[line, best] = False
            nbrs = np.where(go[:, None], graph[ids[line, best]], -1)
            new = look(nbrs)
            ids, near, open_ = np.concatenate([ids, np.maximum(nbrs, 0)], axis=1), np.concatenate([near, new], axis=1), np.concatenate([open_, new > -2], axis=1)
            if ids.shape[1] > beam:
                keep = np.argpartition(-near, beam - 1, axis=1)[:, :beam]
                ids, near, open_ = (np.take_along_axis(x, keep, axis=1) for x in (ids, near, open_))
        qi, ri = (np.concatenate(x) for x in zip(*hits, strict=True))
        held_q, held_r = [], []
        while len(qi):
            code = np.unique(qi * (n + 1) + ri)
            qi, ri = code // (n + 1), code % (n + 1)
            held_q.append(qi)
            held_r.append(ri)
            next_q, next_r = [], []
            for s in range(0, len(qi), 20_000):
                many = degree[ri[s:s + 20_000]]
                i = np.repeat(qi[s:s + 20_000], many)
                r = heads[np.arange(len(i)) - np.repeat(np.cumsum(many) - many - begin[ri[s:s + 20_000]], many)]
                fresh = ~seen[i, r]
                code = np.unique(i[fresh] * (n + 1) + r[fresh])
                i, r = code // (n + 1), code % (n + 1)
                seen[i, r] = True
                close = np.einsum("pd,pd->p", q[i], small[r]) >= least - 1e-4
                next_q.append(i[close])
                next_r.append(r[close])
            qi, ri = np.concatenate(next_q), np.concatenate(next_r)
        found_q, found_r = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if held_q:
            qi, ri = np.concatenate(held_q), np.concatenate(held_r)
            for s in range(0, len(qi), 100_000):
                i, r = qi[s:s + 100_000], ri[s:s + 100_000]
                sure = np.einsum("pd,pd->p", queries[lo + i], rows[r]) >= least
                found_q.append(lo + i[sure])
                found_r.append(r[sure])
        yield np.concatenate(found_q), np.concatenate(found_r)


def padded(lists: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(lists), max([1, *map(len, lists)])), -1, np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def valid_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``embeddings`` with ``vec``: the vector as single-precision bytes, null where it links with nothing."""
    good = (F.col(vector).isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False)))
    sizes = embeddings.where(good).groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    good = good & (F.size(vector) == (most["size"] if most else 0))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["vec"] = [None if v is None else np.asarray(v, np.float32).tobytes() for v in frame["v"]]
            yield frame[["vec_id", "vec"]]

    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, F.col(vector)).cast("array<float>").alias("v")).mapInPandas(pack, "vec_id long, vec binary")


def deal(placed: DataFrame, *, most_home: int, most_asked: int, overlap: int) -> DataFrame:
    """``placed(node, vec, n, shard, place)`` dealt over the parts and blocks of each shard."""
    sizes = placed.groupBy("shard").agg(F.greatest(F.lit(1), F.ceil(F.count_if(F.col("place") == 0) / most_home)).alias("parts"),
                                        F.ceil(F.count("*") / most_asked).alias("blocks"))
    # a vector asks in one block of every part of all its shards, and is a graph node in all blocks of one part of its first ones
    dealt = (placed.join(sizes, "shard").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
             .withColumn("mine", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks"))))
    cell = lambda part, block: F.struct(part.cast("int").alias("part"), block.cast("int").alias("block"))
    asks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda part: cell(part, F.col("mine")))
    stands = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda block: cell(F.col("own"), block))
    cells = F.when(F.col("place") < overlap, F.array_union(asks, stands)).otherwise(asks)
    return (dealt.withColumn("cell", F.explode(cells)).withColumn("asks", F.col("cell.block") == F.col("mine"))
            .withColumn("in_graph", (F.col("place") < overlap) & (F.col("cell.part") == F.col("own")))
            .select("shard", "cell.part", "cell.block", "node", "vec", "n", "place", "asks", "in_graph"))


def link(nodes: DataFrame, *, least: float, shard_rows: int, most_home: int, most_asked: int, sample_rows: int, overlap: int, probes: int,
         beam: int, degree: int, nearest: int, pool: int, alpha: float, medoids: int) -> DataFrame:
    """(node, linked, partners, other) of ``nodes(node, vec, n)``: per query and task the rows and vectors in range, or a forest link."""
    total = nodes.count()
    if not total:
        return nodes.select("node", F.col("n").alias("linked"), F.col("n").alias("partners"), F.col("node").alias("other"))
    sample = unit([r["vec"] for r in nodes.orderBy(F.xxhash64("node")).limit(sample_rows).select("vec").collect()])
    k = max(1, min(-(-total // shard_rows), len(sample) // 8))
    centres = centroids_of(sample, k)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            near = unit(frame["vec"].tolist()) @ centres.T
            order = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            for place in range(order.shape[1]):
                yield frame.assign(shard=order[:, place].astype(np.int32), place=np.int32(place))

    placed = written(nodes.select("node", "vec", "n").mapInPandas(assign, "node long, vec binary, n long, shard int, place int"), "shards")
    rows = deal(placed, most_home=most_home, most_asked=most_asked, overlap=overlap)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        ids = frame["node"].to_numpy()
        graph = pruned_graph(unit(frame["vec"].tolist()), degree=degree, nearest=nearest, pool=pool, alpha=alpha)
        return pd.DataFrame({"node": ids, "near": [ids[g] for g in graph]})

    adjacency = written(rows.where("in_graph and block = 0").select("shard", "part", "node", "vec").groupBy("shard", "part").applyInPandas(build, "node long, near array<long>")
                        .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency")
    lists = written(rows.where("in_graph").select("shard", "part", "block", "node").join(adjacency, "node"), "lists")

    def search(frame: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        ids, vectors = frame["node"].to_numpy(), unit(frame["vec"].tolist())
        inside, asked = np.flatnonzero(frame["in_graph"].to_numpy()), np.flatnonzero(frame["asks"].to_numpy())
        nothing = pd.DataFrame({"node": pd.Series(dtype="int64"), **{c: pd.Series(dtype="Int64") for c in ("linked", "partners", "other")}})
        if not len(inside) or not len(asked):
            return nothing
        known, rows = ids[inside], vectors[inside]
        near = dict(zip(around["node"], around["near"], strict=True))

        def local(node: int) -> np.ndarray:
            want = np.asarray(near[node], np.int64)
            at = np.minimum(np.searchsorted(known, want), len(known) - 1)
            return at[known[at] == want]

        graph = [local(x) for x in known.tolist()]
        own = np.full(len(ids), -1, np.int64)
        own[inside] = np.arange(len(inside))
        home = (frame["place"].to_numpy() == 0)[inside]
        weight = np.where(home, frame["n"].to_numpy()[inside], 0)
        linked, partners = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        tree = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for qi, ri in range_search(rows, graph, medoids_of(rows, medoids), vectors[asked], own[asked], least=least, beam=beam):
            qi = asked[qi]
            other = ids[qi] != known[ri]
            qi, ri = qi[other], ri[other]
            linked += np.bincount(qi, weights=weight[ri], minlength=len(ids)).astype(np.int64)
            partners += np.bincount(qi, weights=home[ri], minlength=len(ids)).astype(np.int64)
            tree = spanning(np.concatenate([tree[0], qi]), np.concatenate([tree[1], inside[ri]]), len(ids))
        counted = np.flatnonzero(linked)
        none = lambda k: pd.array([None] * k, "Int64")
        a, b = tree
        return pd.concat([nothing, pd.DataFrame({"node": ids[counted], "linked": linked[counted], "partners": partners[counted], "other": none(len(counted))}),
                          pd.DataFrame({"node": ids[a], "linked": none(len(a)), "partners": none(len(a)), "other": ids[b]})])

    unit_of = ("shard", "part", "block")
    return (rows.groupBy(*unit_of).cogroup(lists.groupBy(*unit_of))
            .applyInPandas(search, "node long, linked long, partners long, other long"))


def audit(nodes: DataFrame, found: DataFrame, *, least: float, queries: int) -> float:
    """The recall of ``queries`` nodes (by a hash) by brute force over all nodes: the smaller of two shares.

    One is the share of all their links that the search has found; the other is the mean, over nodes with links, of the
    share of a node's linked vectors, copies counted once, so that a large group does not hide the missed links of others.
    """
    asked = nodes.orderBy(F.xxhash64(F.lit("audit"), "node")).limit(queries).select("node", "vec").collect()
    if not asked:
        return 1.0
    ids, vectors = np.array([r["node"] for r in asked]), unit([r["vec"] for r in asked])

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, single = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for frame in frames:
            if len(frame):
                close = vectors @ unit(frame["vec"].tolist()).T >= least
                close &= ids[:, None] != frame["node"].to_numpy()[None, :]
                total += close @ frame["n"].to_numpy()
                single += close.sum(axis=1)
        yield pd.DataFrame({"node": ids, "links": total, "singles": single})

    truth = nodes.select("node", "vec", "n").mapInPandas(exact, "node long, links long, singles long").groupBy("node").agg(F.sum("links").alias("links"), F.sum("singles").alias("singles"))
    both = truth.join(found.groupBy("node").agg(F.sum("linked").alias("linked"), F.sum("partners").alias("partners")), "node", "left").where("links > 0")
    got = both.agg(F.sum(F.least(F.coalesce("linked", F.lit(0)), "links")).alias("a"), F.sum("links").alias("b"),
                   F.avg(F.least(F.coalesce("partners", F.lit(0)), "singles") / F.col("singles")).alias("mean")).first()
    return 1.0 if not got["b"] else min(got["a"] / got["b"], got["mean"])


def near_duplicates(embeddings: DataFrame, vector: str = "embedding", *, least: float = 0.9, shard_rows: int = 1500, most_home: int = 6000, most_asked: int = 12000,
                    sample_rows: int = 16384, overlap: int = 2, probes: int = 4, beam: int = 16, degree: int = 20, nearest: int = 6,
                    pool: int = 32, alpha: float = 1.2, medoids: int = 8, audited: int = 500, recall: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``embeddings``.

    ``component_id`` is the smallest id reachable (nulls aside), for rows without links their own.  The
    search is run again, twice as wide, while the audited recall is below ``recall``, three times at most.
    """
    rows = written(valid_vectors(embeddings, vector).withColumn("key", F.unhex(F.md5("vec"))), "vectors")
    nodes = written(rows.where("vec is not null").groupBy("key").agg(F.any_value("vec").alias("vec"), F.min("vec_id").alias("first"), F.count("*").alias("n"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    for attempt in range(3):
        wide = 2 ** attempt
        found = written(link(nodes, least=least, shard_rows=shard_rows, most_home=most_home, most_asked=most_asked, sample_rows=sample_rows, overlap=overlap * wide,
                             probes=probes * wide, beam=beam * wide, degree=degree, nearest=nearest, pool=pool, alpha=alpha, medoids=medoids * wide), "links")
        reached = audit(nodes, found, least=least, queries=audited)
        if reached >= recall:
            break
    else:
        raise ValueError(f"recall {reached:.3f} is below {recall} even with the widest search")
    joined = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    labelled = (nodes.select("node", "key", "first", "n").join(joined, "node", "left").join(linked, "node", "left")
                .withColumn("component", F.coalesce("component", "node")))
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    named = labelled.join(smallest, "component").select("key", "component_id", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
