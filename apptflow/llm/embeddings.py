"""Embedding near-duplicates by robust-pruned flat graphs.

Vectors are compared within a label. Equal vectors are one node first, so copies never
form pairs. Each label is cut into clusters around centres fitted on a bounded sample
(``SAMPLE_ROWS`` per label), and a vector joins its ``OVERLAP`` nearest clusters. In
each cluster shard a graph is built: neighbours by similarity, pruned robustly (a
neighbour goes if a closer one leads to it), at most ``DEGREE`` per vector. The
adjacency lists of all shards are united, and every vector is looked up by greedy
search from the shard's medoid over the united lists; once a vector within the range
is met the search goes on from every such vector until no new one turns up. Every
link is verified by the exact cosine in double precision. A pair that meets in several
shards counts in the first of them, which checks such pairs exactly. Recall is audited against
brute force on nodes asked until ``AUDIT_LINKS`` true links have been seen, and the
search widened if it falls short. If that does not help, shards are compared exactly;
a run that still falls short fails.

A shard larger than ``SHARD_ROWS`` is cut into blocks; each pair of blocks is a task
that searches one block's graph for the other's vectors, so no task grows with a hot
cluster.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptflow.llm.common import components, mix, stored

THRESHOLD = 0.98
#: vectors per label that centres are fitted on, and centres per label at most
SAMPLE_ROWS = 4000
CENTRES = 512
OVERLAP = 2
#: vectors per cluster that the number of centres aims at, and in one block at most
CLUSTER_ROWS = 700
SHARD_ROWS = 2048
DEGREE = 24
CANDIDATES = 48
ALPHA = 1.2
BEAM = 32
FAR = 4
#: vectors whose neighbours are looked up at once
FRONT = 512
MEDOIDS = 8
#: vectors that one task assigns to clusters
ASSIGN_ROWS = 20_000
#: nodes that the audit asks first, at once at most, and of small tables all in all;
#: of larger tables it asks one in ``AUDIT_ONE_IN`` until it has seen enough true links
AUDIT_QUERIES = 300
AUDIT_BLOCK = 8192
AUDIT_NODES = 6000
AUDIT_ONE_IN = 20
AUDIT_LINKS = 300
AUDIT_RECALL = 0.9

log = logging.getLogger(__name__)


# --------------------------------------------------------------- graph of a shard


def _pruned(x: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES) -> np.ndarray:
    """Robust-pruned neighbour lists, -1 where there is none.

    ``FAR`` more neighbours of each vector lie anywhere, so that a tight group of
    vectors does not become an island.
    """
    n = len(x)
    out = np.full((n, degree + FAR), -1, np.int64)
    c = min(candidates, n - 1)
    if c <= 0:
        return out
    for at in range(0, n, 512):
        rows = np.arange(at, min(n, at + 512))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -2
        near = np.argpartition(-sim, c - 1, axis=1)[:, :c]
        order = np.argsort(-np.take_along_axis(sim, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        dist = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(sim, near, 1), 0))
        y = x[near]
        between = np.sqrt(np.maximum(2 - 2 * (y @ y.transpose(0, 2, 1)), 0))
        alive = np.ones(near.shape, bool)
        taken = np.zeros(len(rows), np.int64)
        for k in range(c):
            r = np.flatnonzero(alive[:, k] & (taken < degree))
            out[rows[r], taken[r]] = near[r, k]
            taken[r] += 1
            alive[r] &= ALPHA * between[r, k] > dist[r]
    place = np.arange(n, dtype=np.uint64)
    for k in range(FAR):
        other = (mix(place * np.uint64(FAR) + np.uint64(k)) % np.uint64(n)).astype(np.int64)
        out[:, degree + k] = np.where(other == place.astype(np.int64), -1, other)
    return out


def _medoids(x: np.ndarray, most: int) -> np.ndarray:
    """The vectors nearest to the means of up to ``most`` groups."""
    means = _centres(x, min(most, max(1, len(x) // 16)), rounds=2)
    return np.unique(np.argmax(x @ means.T, axis=0))


@dataclass
class Graph:
    """Neighbour lists end to end; a node may have any number of them."""

    ends: np.ndarray
    others: np.ndarray

    def near(self, query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours of each node, with its query."""
        size = self.ends[node + 1] - self.ends[node]
        shift = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(query, size), self.others[np.repeat(self.ends[node], size) + shift]


def _search(
    x: np.ndarray,
    graph: Graph,
    queries: np.ndarray,
    own: np.ndarray | None,
    threshold: float,
    beam: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs within the range, by greedy search with range expansion.

    Starts from the medoids and, for queries that are vectors of the graph, from their
    own place ``own``.
    """
    n, low = len(x), np.float32(threshold - 1e-4)
    medoids = _medoids(x, MEDOIDS)
    beam = max(min(beam, n), len(medoids) + 1)
    found_q, found_v = [], []
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        b = len(q)
        seen = np.zeros((b, n), bool)
        value = np.full((b, beam), -9, np.float32)
        node = np.full((b, beam), -1, np.int64)
        node[:, : len(medoids)] = medoids
        if own is not None:
            mine = own[at : at + 256]
            node[:, len(medoids)] = np.where(np.isin(mine, medoids), -1, mine)
        fresh = node >= 0
        r, k = np.nonzero(fresh)
        value[r, k] = _dots(q, x, r, node[r, k])
        seen[r, node[r, k]] = True
        hit = np.zeros((b, n), bool)
        hit[r, node[r, k]] = value[r, k] >= low
        for _ in range(4 * n):
            best = np.where(fresh, value, -9)
            pick = np.argsort(-best, axis=1, kind="stable")[:, :4]
            on = np.take_along_axis(fresh, pick, 1)
            if not on.any():
                break
            np.put_along_axis(fresh, pick, False, 1)
            r, k = np.nonzero(on)
            r, v = graph.near(r, np.take_along_axis(node, pick, 1)[r, k])
            ok = ~seen[r, v]
            pair = np.unique(r[ok] * n + v[ok])
            r, v = pair // n, pair % n
            seen[r, v] = True
            sim = _dots(q, x, r, v)
            hit[r, v] = sim >= low
            # the best of the beam and the new ones stay
            count = np.bincount(r, minlength=b)
            width = int(count.max()) if len(r) else 0
            if not width:
                continue
            place = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
            new_value = np.full((b, width), -9, np.float32)
            new_node = np.full((b, width), -1, np.int64)
            new_value[r, place], new_node[r, place] = sim, v
            value, node = np.hstack([value, new_value]), np.hstack([node, new_node])
            fresh = np.hstack([fresh, new_node >= 0])
            keep = np.argsort(-value, axis=1, kind="stable")[:, :beam]
            value, node, fresh = (np.take_along_axis(z, keep, 1) for z in (value, node, fresh))
        # range expansion: from every vector in range to its neighbours, until none is new
        waiting = [np.nonzero(hit)]
        while waiting:
            front = waiting.pop()
            if len(front[0]) > FRONT:
                waiting.append((front[0][FRONT:], front[1][FRONT:]))
            r, v = graph.near(front[0][:FRONT], front[1][:FRONT])
            ok = ~seen[r, v]
            pair = np.unique(r[ok] * n + v[ok])
            r, v = pair // n, pair % n
            seen[r, v] = True
            good = _dots(q, x, r, v) >= low
            r, v = r[good], v[good]
            hit[r, v] = True
            if len(r):
                waiting.append((r, v))
        r, v = np.nonzero(hit)
        found_q.append(r + at)
        found_v.append(v)
    none = np.zeros(0, np.int64)
    return np.concatenate(found_q or [none]), np.concatenate(found_v or [none])


def _compared(x: np.ndarray, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs within the range, by comparing all."""
    low = np.float32(threshold - 1e-4)
    none = np.zeros(0, np.int64)
    found = [(none, none)]
    for at in range(0, len(queries), 512):
        q, v = np.nonzero(queries[at : at + 512] @ x.T >= low)
        found.append((q + at, v))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _dots(q: np.ndarray, x: np.ndarray, r: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Products of paired rows, some at a time."""
    out = np.empty(len(r), np.float32)
    for at in range(0, len(r), 1 << 15):
        own = slice(at, at + (1 << 15))
        out[own] = np.einsum("ij,ij->i", q[r[own]], x[v[own]])
    return out


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, in double precision."""
    a, b = a.astype(float), b.astype(float)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


# --------------------------------------------------------------------- clustering


def _centres(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means of unit rows; starts from evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def _unit(column: pa.Array) -> np.ndarray:
    column = column if isinstance(column, pa.Array) else column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _raw(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _usable():
    """Whether a row can link with anything."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0.0)
    have = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return F.coalesce(have & good & some, F.lit(False))


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable vectors, and one node per label and distinct vector.

    rows: vec_id, node. nodes: node (smallest vec_id), label, dim, v, copies.
    """
    v = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.where(_usable()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("v")
    )
    nodes = rows.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = stored(nodes, "nodes")
    rows = rows.join(nodes, ["label", "v"])
    return rows.select("vec_id", "node", "copies"), nodes.select(
        "node", "label", F.size("v").alias("dim"), "v", "copies"
    )


def _fit_centres(nodes: DataFrame, sample_rows: int, cluster_rows: int, most: int) -> DataFrame:
    """(label, dim, centres): centres of each label, in one task a label.

    A label's sample is the rows whose hash falls below a share that leaves about
    ``sample_rows`` of them; its number of centres follows from its size.
    """
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    few = nodes.select("label", "dim", "node", "v", part.alias("p")).join(sizes, ["label", "dim"])
    few = few.where(F.col("p") < F.lit(float(sample_rows)) / F.col("size"))

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        x = _unit(group.column("v").combine_chunks())
        size = group.column("size")[0].as_py()
        k = int(max(1, min(most, -(-size // cluster_rows), max(1, len(x) // 4))))
        c = _centres(x, k)
        return pa.table(
            {
                "label": group.column("label").slice(0, 1),
                "dim": group.column("dim").slice(0, 1),
                "centres": pa.array([c.ravel().tolist()], pa.list_(pa.float32())),
            }
        )

    return few.groupBy("label", "dim").applyInArrow(fit, "label string, dim int, centres array<float>")


def near_links(
    nodes: DataFrame,
    threshold: float = THRESHOLD,
    overlap: int = OVERLAP,
    beam: int = BEAM,
    sample_rows: int = SAMPLE_ROWS,
    cluster_rows: int = CLUSTER_ROWS,
    shard_rows: int = SHARD_ROWS,
    exact: bool = False,
) -> DataFrame:
    """(node, links, root): what each task found of a node.

    ``links`` counts vectors of other nodes (copies included). A pair that meets in several
    shards is counted by the task of the first of these alone, which therefore checks all
    such pairs exactly: whichever shard's search finds the pair, it counts, and once. So
    what is passed on grows with the nodes, not with their links. ``root`` is the smallest
    node of the task that the found links connect the node to. ``exact`` compares all pairs
    of each task instead of searching.
    """
    centres = _fit_centres(nodes, sample_rows, cluster_rows, CENTRES)
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / ASSIGN_ROWS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).cast("int")
    split = nodes.join(sizes, ["label", "dim"]).withColumn("part", part).drop("parts")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    spread = centres.join(sizes, ["label", "dim"]).select("label", "dim", "centres", every)

    def assign(rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({**{c: rows.column(c) for c in names}, "shards": pa.array([], pa.list_(pa.int32()))})
        # a label that the sample missed has one cluster
        near = np.zeros((rows.num_rows, 1), np.int64)
        if found.num_rows:
            flat = found.column("centres").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            c = flat.reshape(-1, rows.column("dim")[0].as_py())
            sim = _unit(rows.column("v").combine_chunks()) @ c.T
            take = min(overlap, len(c))
            near = np.sort(np.argpartition(-sim, take - 1, axis=1)[:, :take], axis=1)
        shards = pa.array(near.tolist(), pa.list_(pa.int32()))
        return pa.table({**{c: rows.column(c) for c in names}, "shards": shards})

    names = ("node", "label", "dim", "v", "copies")
    schema = "node long, label string, dim int, v array<double>, copies long, shards array<int>"
    group = ["label", "dim", "part"]
    placed = split.groupBy(*group).cogroup(spread.groupBy(*group)).applyInArrow(assign, schema)
    placed = stored(placed, "placed")
    members = placed.withColumn("shard", F.explode("shards"))
    sizes = members.groupBy("label", "dim", "shard").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("blocks"))
    members = members.join(sizes, ["label", "dim", "shard"])
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    # adjacency lists of all shards, united per node
    key = ["label", "dim", "shard", "block"]

    def build(group: pa.Table) -> pa.Table:
        ids = group.column("node").to_numpy()
        order = np.argsort(ids, kind="stable")
        x = _unit(group.column("v").combine_chunks())[order]
        ids = ids[order]
        graph = _pruned(x)
        lists = [ids[g[g >= 0]].tolist() for g in graph]
        return pa.table({"node": ids, "near": pa.array(lists, pa.list_(pa.int64()))})

    lists = members.select(*key, "node", "v").groupBy(*key).applyInArrow(build, "node long, near array<long>")
    lists = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    members = stored(members.join(lists, "node"), "members")

    # each block meets itself and the other blocks of its shard
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    tasks = members.select("node", "label", "dim", "v", "copies", "shards", "near", "shard", "block", other)
    tasks = tasks.withColumn("bi", F.least("block", "o")).withColumn("bj", F.greatest("block", "o"))
    tasks = tasks.drop("o")

    def link(group: pa.Table) -> pa.Table:
        ids = group.column("node").to_numpy()
        order = np.argsort(ids, kind="stable")
        group, ids = group.take(pa.array(order)), ids[order]
        raw = _raw(group.column("v").combine_chunks())
        x = (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)
        copies, block = group.column("copies").to_numpy(), group.column("block").to_numpy()
        bi, bj = group.column("bi")[0].as_py(), group.column("bj")[0].as_py()
        shard, table = group.column("shard")[0].as_py(), _table(group.column("shards").to_pylist())
        index = np.flatnonzero(block == bj)
        if not len(index):
            return empty
        graph = None if exact else _inner_graph(group.column("near").combine_chunks(), ids, index)
        if exact:
            asks = np.flatnonzero(block == bi)
            a, b = _compared(x[index], x[asks], threshold)
            a, b = asks[a], index[b]
        elif bi == bj:
            a, b = _search(x, graph, x, np.arange(len(x)), threshold, beam)
        else:
            asks = np.flatnonzero(block == bi)
            a, b = _search(x[index], graph, x[asks], None, threshold, beam)
            a, b = asks[a], index[b]
        if not exact:
            more = _first_met(x, table, shard, np.flatnonzero(block == bi), index, threshold)
            a, b = np.concatenate([a, more[0]]), np.concatenate([b, more[1]])
        a, b = np.minimum(a, b), np.maximum(a, b)
        pair = np.unique(a[a != b] * len(ids) + b[a != b])
        a, b = pair // len(ids), pair % len(ids)
        true = [
            _cosine(raw[a[i : i + 65536]], raw[b[i : i + 65536]]) >= threshold
            for i in range(0, len(a), 65536)
        ]
        true = np.concatenate(true or [np.zeros(0, bool)])
        a, b = a[true], b[true]
        own = _first_common(table, a, b) == shard
        links = _tallied(a[own], b[own], copies)
        root = np.arange(len(ids))
        while len(a):
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return pa.table({"node": ids[some], "links": links[some], "root": ids[root[some]]})

    empty = pa.table({c: pa.array([], pa.int64()) for c in ("node", "links", "root")})
    schema = "node long, links long, root long"
    return tasks.groupBy("label", "dim", "shard", "bi", "bj").applyInArrow(link, schema)


def _table(lists: list[list[int]]) -> np.ndarray:
    """The shards of each node, -1 where there are fewer."""
    width = max(map(len, lists))
    return np.array([s + [-1] * (width - len(s)) for s in lists])


def _first_common(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest shard in which the nodes of each pair meet."""
    none = np.iinfo(np.int64).max
    first = np.full(len(a), none)
    for i in range(table.shape[1]):
        for j in range(table.shape[1]):
            met = (table[a, i] == table[b, j]) & (table[a, i] >= 0)
            first = np.minimum(first, np.where(met, table[a, i], none))
    return first


def _first_met(
    x: np.ndarray, table: np.ndarray, shard: int, asks: np.ndarray, index: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the range that meet in later shards too, and in no earlier one."""
    none = np.zeros(0, np.int64)
    found = [(none, none)]
    for later in np.unique(table[table > shard]).tolist():
        mine = asks[(table[asks] == later).any(axis=1)]
        others = index[(table[index] == later).any(axis=1)]
        if len(mine) and len(others):
            a, b = _compared(x[others], x[mine], threshold)
            found.append((mine[a], others[b]))
    a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    own = _first_common(table, a, b) == shard
    return a[own], b[own]


def _tallied(a: np.ndarray, b: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Links of each node over the pairs, copies of the other node included."""
    n = len(copies)
    return (np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)).astype(np.int64)


def link_counts(found: DataFrame) -> DataFrame:
    """(node, links) over all tasks of ``near_links``."""
    return found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))


def _inner_graph(near: pa.Array, ids: np.ndarray, index: np.ndarray) -> Graph:
    """The united lists among the rows ``index``, both ways, as places in ``index``."""
    place = np.full(len(ids), -1)
    place[index] = np.arange(len(index))
    ends = near.offsets.to_numpy()
    flat = near.flatten().to_numpy()
    u = np.repeat(np.arange(len(ids)), np.diff(ends))
    at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
    inside = (ids[at] == flat) & (place[u] >= 0) & (place[at] >= 0)
    u, v = place[u[inside]], place[at[inside]]
    pair = np.unique(np.concatenate([u * len(index) + v, v * len(index) + u]))
    u, v = pair // len(index), pair % len(index)
    return Graph(np.concatenate([[0], np.cumsum(np.bincount(u, minlength=len(index)))]), v)


# ----------------------------------------------------------------------- operator


def brute_links(nodes: DataFrame, queries: list, threshold: float) -> DataFrame:
    """(node, links) of few query nodes by comparing them with every node."""
    if not queries:
        return nodes.select("node", F.lit(0).cast("long").alias("links")).where("false")
    sent = nodes.sparkSession.sparkContext.broadcast(
        [(q.node, q.label, q.dim, np.array(q.v, float)) for q in queries]
    )

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for part in parts:
            label = np.array(part.column("label").to_pylist(), object)
            dim = part.column("dim").to_numpy(zero_copy_only=False)
            ids = part.column("node").to_numpy(zero_copy_only=False)
            copies = part.column("copies").to_numpy(zero_copy_only=False)
            for key in {(q[1], q[2]) for q in sent.value}:
                at = np.flatnonzero((label == key[0]) & (dim == key[1]))
                if not len(at):
                    continue
                raw = _raw(part.column("v").take(pa.array(at)))
                raw /= np.linalg.norm(raw, axis=1, keepdims=True)
                own = [q for q in sent.value if (q[1], q[2]) == key]
                for i in range(0, len(own), 256):
                    name = np.array([q[0] for q in own[i : i + 256]])
                    unit = np.stack([q[3] / np.linalg.norm(q[3]) for q in own[i : i + 256]])
                    near = (raw @ unit.T >= threshold) & (ids[at][:, None] != name)
                    for k, n in zip(name.tolist(), (copies[at] @ near).tolist(), strict=True):
                        total[k] = total.get(k, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["node", "links"]
        )

    return nodes.mapInArrow(batch, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


@dataclass
class Audit:
    """What the audit saw: nodes asked, true links of theirs, and those that were found."""

    asked: int = 0
    true: int = 0
    found: int = 0

    @property
    def recall(self) -> float | None:
        return self.found / self.true if self.true else None


def audit(nodes: DataFrame, links: DataFrame, threshold: float = THRESHOLD, enough: int = AUDIT_LINKS) -> Audit:
    """Compares ``links`` (node, links) with brute force over nodes chosen by hash.

    Asks block after block, each twice as large as the one before, until ``enough`` true
    links have been seen, all of a small table or one in ``AUDIT_ONE_IN`` nodes asked.
    """
    size = nodes.count()
    most = min(size, max(AUDIT_NODES, size // AUDIT_ONE_IN))
    place = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1 << 30))
    seen, block, at = Audit(), AUDIT_QUERIES, 0
    while at < most and seen.true < enough:
        to = min(most, at + block)
        low, high = at * (1 << 30) // size, to * (1 << 30) // size
        asks = nodes.where((place >= low) & (place < high)).collect()
        both = brute_links(nodes, asks, threshold).withColumnRenamed("links", "want").join(links, "node", "left")
        got = F.least("want", F.coalesce("links", F.lit(0)))
        sums = both.agg(F.sum("want").alias("want"), F.sum(got).alias("got")).first()
        seen = Audit(seen.asked + len(asks), seen.true + (sums["want"] or 0), seen.found + (sums["got"] or 0))
        at, block = to, min(2 * block, AUDIT_BLOCK)
    return seen


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """vec_id, n_links and component_id for every row of ``vectors``.

    Needs vec_id, embedding and label. A row whose label, id or vector is null, whose
    vector is zero or has a null or non-finite part, links with nothing and is its own
    component; so do vectors of different lengths. Rows with equal vectors and labels
    link with each other. Repeated rows each get a row. Other columns are ignored and
    an empty table gives an empty result. Rows that share a vec_id but not the vector are one
    node, whose links are those of all its vectors. The audit's figures are logged; a recall below
    ``AUDIT_RECALL`` that no widening mends fails the job.
    """
    rows, nodes = nodes_of(vectors)
    overlap, beam = options.pop("overlap", OVERLAP), options.pop("beam", BEAM)
    for exact in (False, False, False, True):
        found = stored(near_links(nodes, threshold, overlap, beam, exact=exact, **options), "links")
        links = stored(link_counts(found), "counts")
        seen = audit(nodes, links, threshold)
        log.warning(
            "link audit: %d nodes asked, %d of %d true links found, recall %s (%s, overlap %d)",
            seen.asked, seen.found, seen.true, "unmeasured" if seen.recall is None else f"{seen.recall:.4f}",
            "shards compared" if exact else f"beam {beam}", overlap,
        )
        if seen.recall is None or seen.recall >= AUDIT_RECALL:
            break
        overlap, beam = overlap + 1, beam * 2
    else:
        raise RuntimeError(f"only {seen.found} of {seen.true} audited links were found")
    groups = components(found.select("node", "root"), "node", "root")
    result = rows.join(links, "node", "left").join(groups, "node", "left")
    result = result.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    rest = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _usable().alias("_ok"))
    rest = rest.where(~F.coalesce("_ok", F.lit(False)))
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionByName(rest)
