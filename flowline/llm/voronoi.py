"""Exact top-k by inner product as a Voronoi kNN join.

Vectors are scaled to integers (floor(256 x)).  A larger inner product is a
smaller Euclidean distance once every data vector x has the extra component
sqrt(M - |x|**2), M the largest |x|**2, and every query a zero there:
|q - x|**2 = |q|**2 + M - 2 q.x.  In that space:

1. *Pivots*: a bounded sample of the data, with a zero for the extra component.
   Each query belongs to the cell of its nearest pivot.
2. *Summaries*: for each pivot the distance that the k + 1 nearest ids of the
   data lie within; for each cell of queries their number and bounds.
3. *Bounds*: a query has k neighbours (and maybe itself) within its distance to
   any pivot plus that pivot's distance of step 2; the smallest such sum is the
   query's own reach.  Seen from a pivot p, all it needs lies between d(q, p) -
   reach and d(q, p) + reach; a cell keeps the least and the greatest of these
   for every pivot.
4. *Replication*: cells are packed into as many *reducers* as their queries
   fill, near cells together; a cell with more queries than a reducer takes is
   split.  A data vector goes once to each reducer that holds a cell within
   whose bounds of all pivots it lies, and to none else.  ``replication`` tells
   how many rows each reducer gets.
5. *Local join*: the data of a reducer are split into blocks; each block and the
   reducer's queries are one matrix product, and the k best per query and block
   are merged.

Scores are exact integers; floating point serves for bounds alone, which are
widened by ``SLACK`` (a bound that overflows prunes nothing).  A score beyond
64 bits counts as the nearest 64-bit integer, so that such scores tie.

Nulls and ties: vectors that are null, empty, hold null or non-finite
components (also once scaled) or have another length than the most common one
take no part, nor do rows with a null id.  Ties go to the smaller id.  Rows
repeated with id and vector count once; rows of one id with different vectors
are candidates each, and as queries share one list.  An empty table gives no
rows.  Only the two named columns are read.
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
SCALE = 256
PIVOTS = 64              # a bounded sample
QUERY_BLOCK = 2_048      # queries of a reducer
DATA_BLOCK = 16_384      # data vectors of a block, fewer if they are long
BLOCK_CELLS = 1 << 20    # numbers in a block
SLICE = 256              # queries multiplied at a time
PAIRS = 16_384           # replicated rows put out at a time
SLACK = 1e-6             # widening of the bounds, relative to the largest norm
MOST = 2 ** 63 - 1


def _scaled(vectors: DataFrame) -> DataFrame:
    """(id, x): distinct rows, x the integers as the bytes of doubles (which
    hold them exactly)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                with np.errstate(over="ignore"):
                    v = np.floor(matrix(b.column("x")) * SCALE) + 0.0
                fits = np.isfinite(v).all(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").filter(pa.array(fits)), pa.array([r.tobytes() for r in v[fits]], pa.binary())],
                    names=["id", "x"])

    return vectors.mapInArrow(run, "id long, x binary").distinct()


def _lifted(v: np.ndarray, most: float) -> np.ndarray:
    """Data vectors with their extra component."""
    return np.concatenate([v, np.sqrt(np.maximum(most - (v * v).sum(axis=1), 0))[:, None]], axis=1)


def _flat(v: np.ndarray) -> np.ndarray:
    return np.concatenate([v, np.zeros((len(v), 1))], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _product(q: np.ndarray, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Integer inner products of integer-valued doubles, where ``counts``; each
    pair by the cheapest arithmetic that is exact for it."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < 2 ** 52:
        return (q @ x.T).astype(np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.abs(q) @ np.abs(x).T                       # nan and infinite: too large
    out = np.zeros(size.shape, np.int64)
    fits = counts & (size < 2 ** 62)
    if fits.any():
        # components of 2**62 and more meet only zeros in pairs that fit
        low = [np.where(np.abs(v) < 2 ** 62, v, 0).astype(np.int64) for v in (q, x)]
        out[fits] = (low[0] @ low[1].T)[fits]
    for i, j in zip(*np.nonzero(counts & ~fits)):
        exact = sum(int(a) * int(b) for a, b in zip(q[i].tolist(), x[j].tolist()))
        out[i, j] = max(-MOST, min(MOST, exact))
    return out


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row the places of its k best scores, ties to smaller ids."""
    n = score.shape[1]
    for row in score:
        near = np.arange(n)
        if n > k:
            near = np.flatnonzero(row >= np.partition(row, n - k)[n - k])
        yield near[np.lexsort((ids[near], -row[near]))][:k]


class _Nearest:
    """For each pivot the ``many`` nearest different ids seen."""

    def __init__(self, pivots: int, many: int):
        self.many, self.held = many, [{} for _ in range(pivots)]

    def add(self, ids: np.ndarray, apart: np.ndarray) -> None:
        """``apart``: ids x pivots."""
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.r_[True, ids[order][1:] != ids[order][:-1]])
        least, ids = np.minimum.reduceat(apart[order], first, axis=0), ids[order][first]
        some = min(self.many, len(ids))
        near = np.argpartition(least, some - 1, axis=0)[:some]
        for g, held in enumerate(self.held):
            for i, d in zip(ids[near[:, g]].tolist(), least[near[:, g], g].tolist()):
                held[i] = min(d, held.get(i, np.inf))
            if len(held) > self.many:
                self.held[g] = dict(sorted(held.items(), key=lambda x: x[1])[:self.many])


class _Plan:
    """Pivots, bounds and reducers: what every task needs.  Of the size of
    PIVOTS x PIVOTS, whatever the tables hold."""

    def __init__(self, pivots: np.ndarray, most: float):
        n = len(pivots)
        self.most, self.slack = most, SLACK * (1 + np.sqrt(most))
        self.pivots = _flat(pivots)
        self.near = np.full(n, np.inf)                       # holds the k + 1 nearest ids
        self.low, self.high = np.full((n, n), np.inf), np.full((n, n), -np.inf)
        self.count = np.zeros(n, np.int64)                   # queries of each cell
        self.first, self.parts = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.reducers = 0

    def cells(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each query its cell, and the least and greatest distance from
        each pivot at which it needs data."""
        apart = _distances(_flat(queries), self.pivots)
        reach = (apart + self.near).min(axis=1)[:, None] + self.slack
        return apart.argmin(axis=1), apart - reach, apart + reach

    def pack(self, size: int) -> None:
        """Reducers of up to ``size`` queries, along a chain of near cells."""
        apart = _distances(self.pivots, self.pivots)
        todo, at, room = set(np.flatnonzero(self.count).tolist()), 0, 0
        while todo:
            at = min(todo, key=lambda g: (apart[at, g], g))
            todo.remove(at)
            n = int(self.count[at])
            if n > room:
                self.first[at], self.parts[at] = self.reducers, -(-n // size)
                self.reducers += int(self.parts[at])
                room = max(0, size - n)
            else:
                self.first[at], self.parts[at] = self.reducers - 1, 1
                room -= n

    def needed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, reducer) of every copy that the local joins need."""
        apart = _distances(_lifted(x, self.most), self.pivots)
        rows, reducers = [], []
        for g in np.flatnonzero(self.count):
            out = ((apart < self.low[g]) | (apart > self.high[g])).any(axis=1)   # nan: not out
            row = np.flatnonzero(~out)
            rows.append(np.repeat(row, self.parts[g]))
            reducers.append(np.tile(self.first[g] + np.arange(self.parts[g]), len(row)))
        pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(reducers)], axis=1), axis=0) if rows \
            else np.zeros((0, 2), np.int64)
        return pairs[:, 0], pairs[:, 1]


def _planned(vectors: DataFrame, is_query: Column, k: int, id_col: str, vec_col: str):
    """(plan, queries by reducer, data by reducer and block, number of blocks);
    None without vectors."""
    data = staged(_scaled(usable(vectors, id_col, vec_col)), "voronoi_data")
    chosen = data.orderBy(F.xxhash64("id", "x"), "id").limit(PIVOTS).select("x").collect()
    if not chosen:
        return None
    pivots = np.unique(np.stack([np.frombuffer(r["x"], np.float64) for r in chosen]), axis=0)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = matrix(b.column("x"))
                with np.errstate(over="ignore"):
                    yield pa.RecordBatch.from_arrays([pa.array([(v * v).sum(axis=1).max()]), pa.array([b.num_rows])],
                                                     names=["most", "n"])

    most, total = data.select("x").mapInArrow(squares, "most double, n long").agg(F.max("most"), F.sum("n")).first()
    plan = _Plan(pivots, most)
    n = len(pivots)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Nearest(n, k + 1)
        for b in batches:
            if b.num_rows:
                with np.errstate(over="ignore", invalid="ignore"):
                    apart = _distances(_lifted(matrix(b.column("x")), plan.most), plan.pivots)
                seen.add(b.column("id").to_numpy(), np.where(np.isnan(apart), np.inf, apart))
        rows = [(g, i, d) for g, held in enumerate(seen.held) for i, d in held.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["g", "id", "d"])

    # a task gives k + 1 ids per pivot; so do the merged rows that are collected
    place = Window.partitionBy("g").orderBy("d", "id")
    for r in (data.mapInArrow(nearest, "g long, id long, d double").groupBy("g", "id").agg(F.min("d").alias("d"))
              .withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k + 1)
              .groupBy("g").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("c")).collect()):
        if r["c"] == k + 1:
            plan.near[r["g"]] = r["d"]

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, count = np.full((n, n), np.inf), np.full((n, n), -np.inf), np.zeros(n, np.int64)
        for b in batches:
            if b.num_rows:
                with np.errstate(over="ignore", invalid="ignore"):
                    cell, below, above = plan.cells(matrix(b.column("x")))
                    np.minimum.at(low, cell, below)
                    np.maximum.at(high, cell, above)
                np.add.at(count, cell, 1)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, n)), pa.array(np.tile(np.arange(n), len(some))), pa.array(low[some].ravel()),
             pa.array(high[some].ravel()), pa.array(np.repeat(count[some], n))],
            names=["g", "p", "low", "high", "c"])

    # nan, an overflow, is the greatest double for Spark and bounds nothing
    queries = data.filter(is_query)
    for r in (queries.mapInArrow(bounds, "g long, p long, low double, high double, c long").groupBy("g", "p")
              .agg(F.min(F.when(F.isnan("low"), float("-inf")).otherwise(F.col("low"))).alias("low"),
                   F.max("high").alias("high"), F.sum("c").alias("c")).collect()):
        plan.low[r["g"], r["p"]], plan.high[r["g"], r["p"]], plan.count[r["g"]] = r["low"], r["high"], r["c"]
    plan.pack(QUERY_BLOCK)
    blocks = int(max(1, -(-total // max(1, min(DATA_BLOCK, BLOCK_CELLS // pivots.shape[1])))))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                with np.errstate(over="ignore", invalid="ignore"):
                    cell = plan.cells(matrix(b.column("x")))[0]
                part = b.column("part").to_numpy() % plan.parts[cell]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((plan.first[cell] + part).astype(np.int32)), b.column("id"), b.column("x")],
                    names=["r", "id", "x"])

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                row, reducer = plan.needed(matrix(b.column("x")))
            for i in range(0, len(row), PAIRS):
                rows = b.take(pa.array(row[i:i + PAIRS]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reducer[i:i + PAIRS].astype(np.int32)), rows.column("block"), rows.column("id"),
                     rows.column("x")], names=["r", "block", "id", "x"])

    spread = F.xxhash64("id", "x")
    asked = queries.select("id", "x", F.pmod(spread, F.lit(1 << 30)).alias("part")).mapInArrow(
        placed, "r int, id long, x binary")
    near = data.select("id", "x", F.pmod(spread, F.lit(blocks)).cast("int").alias("block")).mapInArrow(
        replicate, "r int, block int, id long, x binary")
    return plan, asked, near, blocks


def replication(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
                vec_col: str = "embedding") -> DataFrame:
    """reducer, queries, copies: how many queries each reducer holds and how
    many data vectors it is sent."""
    made = _planned(vectors, is_query, k, id_col, vec_col)
    if made is None:
        return vectors.sparkSession.createDataFrame([], "reducer int, queries long, copies long")
    _, asked, near, _ = made
    one, no = F.lit(1).cast("long"), F.lit(0).cast("long")
    return (asked.select("r", one.alias("q"), no.alias("c")).unionAll(near.select("r", no.alias("q"), one.alias("c")))
            .groupBy(F.col("r").alias("reducer")).agg(F.sum("q").alias("queries"), F.sum("c").alias("copies")))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each row where ``is_query``
    (a condition on ``id``) holds, among the rows with another id."""
    made = _planned(vectors, is_query, k, id_col, vec_col)
    if made is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    _, asked, near, blocks = made
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def solve(key, left: pa.Table, right: pa.Table) -> pa.Table:
        parts: list = [[], [], []]
        if left.num_rows and right.num_rows:
            ids, x = right.column("id").to_numpy(), matrix(right.column("x"))
            for i in range(0, left.num_rows, SLICE):
                q, v = left.column("id").to_numpy()[i:i + SLICE], matrix(left.column("x").slice(i, SLICE))
                others = ids != q[:, None]
                score = _product(v, x, others)
                score[~others] = -MOST - 1                   # below every score
                for row, best in enumerate(_best(score, ids, k)):
                    best = best[others[row, best]]
                    parts[0].append(np.full(len(best), q[row]))
                    parts[1].append(ids[best])
                    parts[2].append(score[row, best])
        done = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
        return pa.table({"query_id": done[0], "vec_id": done[1], "score": done[2]})

    found = (asked.groupBy("r", "block").cogroup(near.groupBy("r", "block"))
             .applyInArrow(solve, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op6_voronoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of every 50th vector of ``embeddings``."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def oracle_sql() -> str:
    """The same search for DuckDB."""
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_dot_product(CAST(q.x AS DOUBLE[]), CAST(d.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
