"""Approximate nearest neighbours on robust-pruned directed graphs.

Vectors are scaled to length one and dealt by their hash to shards of about
``SHARD_ROWS`` different vectors.  Per shard, one task builds a graph:

1. every node starts with random neighbours;
2. nodes come in batches in random order: a greedy beam search from the medoid
   proposes the nodes it meets, and *robust pruning* keeps the nearest one,
   drops all proposals to which it is ``alpha`` times nearer than the node
   itself, and goes on with the next, up to ``degree`` edges;
3. each edge is offered back to its end, which is pruned again if it is full.

The graph is written as a table.  A query runs a beam search on every shard;
what the beams hold is scored in double precision on the original vectors,
and the k best are merged.

Equal vectors are one node with the k + 1 smallest of their ids (gathered
by partial aggregation, so a vector in a third of all rows is no hot key);
no more of them can be among k neighbours.

Nulls and ties: vectors that are null, empty, of length zero, hold null or
non-finite components or have another number of components than the most
common take no part, nor do rows with a null id.  Equal scores go to the
smaller id.  An id repeated with its vector counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowline.llm.common import staged, table
from flowline.llm.vectors import matrix, usable

K = 5
SHARD_ROWS = 4_096
QUERY_BLOCK = 4_096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.2
BATCH = 128
WIDTH = 4                # nodes of a beam opened at a time


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe for tiny and huge components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two vectors in double precision."""
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()))


def beam_search(x: np.ndarray, edges: np.ndarray, start: int, q: np.ndarray, beam: int):
    """(ids, similarities) of the ``beam`` best nodes met for each query row,
    the best first; -1 where there are fewer.  ``edges`` holds -1 for none."""
    rows, n = len(q), len(x)
    ids = np.full((rows, beam), -1, np.int64)
    sims = np.full((rows, beam), -np.inf, np.float32)
    opened = np.zeros((rows, beam), bool)
    seen = np.zeros((rows, n + 1), bool)
    ids[:, 0], sims[:, 0] = start, q @ x[start]
    seen[:, start] = True
    seen[:, n] = True                                    # stands for "no edge"
    every = np.arange(rows)[:, None]
    live = np.arange(rows)
    while len(live):
        todo = np.where(opened[live] | (ids[live] < 0), -np.inf, sims[live])
        pick = np.argsort(-todo, axis=1, kind="stable")[:, :WIDTH]
        can = np.take_along_axis(todo, pick, 1) > -np.inf
        live, pick, can = live[can[:, 0]], pick[can[:, 0]], can[can[:, 0]]
        if not len(live):
            break
        r = every[live]
        opened[r, pick] |= can
        near = np.where(can[:, :, None], edges[ids[r, pick]], -1).reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        # a node offered twice in one step counts once
        near.sort(axis=1)
        fresh = ~seen[r, near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[r, near] = True
        near = np.where(fresh, near, 0)
        s = np.einsum("rcd,rd->rc", x[near], q[live])
        s = np.where(fresh, s, -np.inf)
        all_s = np.concatenate([sims[live], s], axis=1)
        all_i = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        all_o = np.concatenate([opened[live], np.zeros(s.shape, bool)], axis=1)
        best = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
        sims[live] = np.take_along_axis(all_s, best, 1)
        ids[live] = np.take_along_axis(all_i, best, 1)
        opened[live] = np.take_along_axis(all_o, best, 1)
    return ids, sims


def robust_prune(x: np.ndarray, node: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-edges of each node from its candidates (-1 for none): the nearest
    candidate that no edge chosen before covers, again and again."""
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    cand[cand == node[:, None]] = -1
    far = np.float32(9.0)
    d = np.where(cand < 0, far, 2 - 2 * np.einsum("rcd,rd->rc", x[cand], x[node]))   # squared distances
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    v = x[cand]
    alive = cand >= 0
    out = np.full((len(node), degree), -1, np.int64)
    rows = np.arange(len(node))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = cand[rows, first][some]
        between = 2 - 2 * np.einsum("rcd,rd->rc", v, v[rows, first])
        alive &= (between * (alpha * alpha) > d) | ~some[:, None]
        alive[rows, first] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
          seed: int = 3) -> tuple[np.ndarray, int]:
    """(edges, start node) of a graph over unit rows (float32)."""
    n, rng = len(x), np.random.default_rng(seed)
    start = int((x @ x.mean(axis=0)).argmax())
    if n <= degree + 1:
        edges = np.full((n, degree), -1, np.int64)
        for i in range(n):
            others = np.delete(np.arange(n), i)
            edges[i, :len(others)] = others
        return edges, start
    edges = rng.integers(0, n - 1, (n, degree))
    edges += edges >= np.arange(n)[:, None]
    order = rng.permutation(n)
    for at in range(0, n, BATCH):
        node = order[at:at + BATCH]
        met, _ = beam_search(x, edges, start, x[node], beam)
        edges[node] = robust_prune(x, node, np.concatenate([met, edges[node]], axis=1), degree, alpha)
        # offer the edges back
        src, dst = np.repeat(node, degree), edges[node].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        known = (edges[dst] == src[:, None]).any(axis=1)
        src, dst = src[~known], dst[~known]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        ends, first, many = np.unique(dst, return_index=True, return_counts=True)
        if not len(ends):
            continue
        offered = np.full((len(ends), int(many.max())), -1, np.int64)
        offered[np.repeat(np.arange(len(ends)), many), np.arange(len(dst)) - np.repeat(first, many)] = src
        have = edges[ends]
        fits = (have >= 0).sum(axis=1) + many <= degree
        for i in np.flatnonzero(fits).tolist():
            free = np.flatnonzero(have[i] < 0)[:many[i]]
            edges[ends[i], free] = offered[i, :many[i]]
        full = np.flatnonzero(~fits)
        for j in range(0, len(full), 512):
            part = full[j:j + 512]
            cand = np.concatenate([have[part], offered[part]], axis=1)
            if cand.shape[1] > 4 * degree:               # hubs: the nearest offers
                s = np.where(cand < 0, -np.inf, np.einsum("rcd,rd->rc", x[cand], x[ends[part]]))
                cand = np.take_along_axis(cand, np.argsort(-s, axis=1, kind="stable")[:, :4 * degree], 1)
            edges[ends[part]] = robust_prune(x, ends[part], cand, degree, alpha)
    return edges, start


def _nodes(vectors: DataFrame, k: int) -> DataFrame:
    """(x, ids): each different non-zero vector with its k + 1 smallest ids."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        for b in batches:
            for i, x in zip(b.column("id").to_pylist(), b.column("x").to_pylist()):
                if any(x):
                    own = held.setdefault(x, [])
                    own.append(i)
                    if len(own) > 4 * (k + 1):
                        held[x] = sorted(set(own))[:k + 1]
            if len(held) >= 50_000:
                yield flush(held)
                held = {}
        if held:
            yield flush(held)

    def flush(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array([sorted(set(v))[:k + 1] for v in held.values()],
                                                         pa.list_(pa.int64()))], names=["x", "ids"])

    part = vectors.filter(F.col("x").isNotNull()).mapInArrow(partial, "x binary, ids array<long>")
    # k + 1 ids per vector and task
    return (part.groupBy("x").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
                                  .alias("ids")))


def _graph(nodes: DataFrame, shards: int) -> DataFrame:
    """(shard, node, start, x, ids, edges): the graphs as a table."""
    def make(key, t):
        t = t.take(pa.array(np.array(sorted(range(t.num_rows), key=t.column("x").to_pylist().__getitem__))))
        x = unit_rows(matrix(t.column("x"))).astype(np.float32)
        edges, start = build(x)
        n = t.num_rows
        return pa.table({"shard": pa.array([key[0].as_py()] * n, pa.int32()), "node": pa.array(np.arange(n, dtype=np.int32)),
                         "start": pa.array(np.full(n, start, np.int32)), "x": t.column("x"), "ids": t.column("ids"),
                         "edges": pa.array([e.astype(np.int32).tobytes() for e in edges], pa.binary())})

    return (nodes.withColumn("shard", F.pmod(F.xxhash64("x"), F.lit(shards)).cast("int"))
            .groupBy("shard").applyInArrow(
                make, "shard int, node int, start int, x binary, ids array<long>, edges binary"))


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
           shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found by cosine of each
    row where ``is_query`` (a condition on ``id``) holds."""
    rows = staged(usable(vectors, id_col, vec_col), "ann_rows")
    nodes = staged(_nodes(rows, k), "ann_nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    graph = staged(_graph(nodes, shards), "ann_graph")
    queries = staged(rows.filter(is_query).distinct(), "ann_queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    held = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(key, left, right):
        parts: list = [[], [], []]
        q = matrix(left.column("x")) if left.num_rows else np.zeros((0, 1))
        who = left.column("id").to_numpy()[(q != 0).any(axis=1)] if left.num_rows else np.zeros(0, np.int64)
        q = q[(q != 0).any(axis=1)]
        if len(q) and right.num_rows:
            right = right.sort_by("node")
            raw = matrix(right.column("x"))
            x = unit_rows(raw)
            edges = np.frombuffer(b"".join(right.column("edges").to_pylist()), np.int32).reshape(len(x), -1).astype(np.int64)
            ids = right.column("ids").to_pylist()
            start = right.column("start")[0].as_py()
            x32, unit = x.astype(np.float32), unit_rows(q)
            for at in range(0, len(q), 256):
                met, _ = beam_search(x32, edges, start, unit[at:at + 256].astype(np.float32), beam)
                for i, near in enumerate(met, at):
                    near = near[near >= 0]
                    close = near[np.argsort(-(x[near] @ unit[i]), kind="stable")[:4 * (k + 1)]]
                    found = sorted((-cosine(q[i], raw[m]), v) for m in close.tolist() for v in ids[m] if v != who[i])[:k]
                    parts[0] += [who[i]] * len(found)
                    parts[1] += [v for _, v in found]
                    parts[2] += [-s for s, _ in found]
        return pa.table({"query_id": pa.array(parts[0], pa.int64()), "vec_id": pa.array(parts[1], pa.int64()),
                         "score": pa.array(parts[2], pa.float64())})

    hits = (asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block"))
            .applyInArrow(find, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_graphann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every 50th vector of ``embeddings``."""
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
