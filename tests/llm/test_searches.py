import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowline.llm import graphann as G
from flowline.llm import voronoi as V

SCHEMA = "vec_id long, embedding array<float>, label int, x int, id string"


def rows(n=700, dim=12, seed=0):
    """Vectors with hot exact and near copies, ties, and unusable ones."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[100:220] = x[100]
    x[300:380] = x[300] + rng.normal(scale=1e-3, size=(80, dim)).astype(np.float32)
    out = [(k, v.tolist(), 0, 1, "a") for k, v in enumerate(x)]
    odd = [None, [], [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] * dim]
    out += [(n + 50 * k, v, 0, 1, "a") for k, v in enumerate(odd)]
    out += [(n + 1000, [0.0] * dim, 0, 1, "a"), (None, x[0].tolist(), 0, 1, "a"), out[0], out[100]]
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


def usable(zero):
    """id -> vector of the rows that take part."""
    return {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows()
            if i is not None and v is not None and len(v) == 12 and None not in v and np.isfinite(v).all()
            and (zero or any(v))}


def test_exact_search_equals_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(V, "DATA_BLOCK", 100)
    monkeypatch.setattr(V, "QUERY_BLOCK", 3)
    data = {i: np.floor(256 * v).astype(np.int64) for i, v in usable(zero=True).items()}
    want = set()
    for q in data:
        if q % 50 == 0:
            best = sorted((-int(data[q] @ v), i) for i, v in data.items() if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in V.top_k(vectors, F.col("id") % 50 == 0).collect()} == want


def test_exact_search_equals_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.register("embeddings", pa.Table.from_pandas(spark.read.parquet(f"{path}/embeddings.parquet").toPandas()))
    want = {(a, int(b), c, d) for a, b, c, d in con.execute(V.oracle_sql()).fetchall()}
    assert {tuple(r) for r in V.op6_voronoi(spark, path).collect()} == want


def brute(data, k=5):
    """The exact search in Python's integers; scores held within 64 bits."""
    most, want = 2 ** 63 - 1, set()
    for q in data:
        if q % 50 == 0:
            score = {i: max(-most, min(most, sum(a * b for a, b in zip(data[q], v)))) for i, v in data.items() if i != q}
            best = sorted(score, key=lambda i: (-score[i], i))[:k]
            want |= {(q, n + 1, i, score[i]) for n, i in enumerate(best)}
    return want


@pytest.mark.parametrize("far", [1e10, 3e15, 1e18, 1e40, 1e200])
def test_exact_search_with_huge_components(spark, far):
    rng = np.random.default_rng(8)
    x = {k: v.tolist() for k, v in enumerate(rng.normal(size=(200, 2)))}
    x |= {500: [far, far], 501: [-far, 1.0], 550: [0.0, 0.0], 600: [far, -1.0]}
    df = spark.createDataFrame(list(x.items()), "vec_id long, embedding array<double>")
    data = {i: [int(np.floor(256 * c)) for c in v] for i, v in x.items()}
    assert {tuple(r) for r in V.top_k(df, F.col("id") % 50 == 0).collect()} == brute(data)


def test_vectors_that_overflow_when_scaled_take_no_part(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1e308, 0.0]), (2, [3.0, 1.0])],
                               "vec_id long, embedding array<double>")
    assert {tuple(r) for r in V.top_k(df, F.col("id") % 50 == 0).collect()} == {(0, 1, 2, 256 * 768 + 512 * 256)}


def test_replication_follows_the_queries(spark, monkeypatch):
    """Far clusters: a vector goes to the reducers of its own cluster; one
    reducer gets each vector once."""
    rng = np.random.default_rng(9)
    n, centres = 4_000, rng.normal(size=(8, 6)) * 50
    centres /= np.linalg.norm(centres, axis=1)[:, None] / 50
    x = (centres[np.arange(n) % 8] + rng.normal(scale=0.5, size=(n, 6))).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    one = V.replication(df, F.col("id") % 50 == 0).collect()
    assert len(one) == 1 and one[0].queries == 80 and one[0].copies <= n
    monkeypatch.setattr(V, "QUERY_BLOCK", 10)
    monkeypatch.setattr(V, "DATA_BLOCK", 500)
    many = V.replication(df, F.col("id") % 50 == 0).collect()
    assert len(many) >= 8 and sum(r.queries for r in many) == 80 and max(r.queries for r in many) <= 40
    assert sum(r.copies for r in many) <= 4 * n              # of 8 n and more without bounds
    data = {k: np.floor(256 * v.astype(float)).astype(int).tolist() for k, v in enumerate(x)}
    assert {tuple(r) for r in V.top_k(df, F.col("id") % 50 == 0).collect()} == brute(data)


def test_one_id_with_many_vectors(spark):
    """A query whose own id holds the nearest vectors still gets k others."""
    rng = np.random.default_rng(10)
    x = [(0, v) for v in (rng.normal(scale=0.01, size=(40, 3)) + 9).tolist()]
    x += [(k, v) for k, v in enumerate(rng.normal(size=(60, 3)).tolist(), 1)]
    df = spark.createDataFrame(x, "vec_id long, embedding array<double>")
    v = [(i, np.floor(256 * np.array(c)).astype(np.int64)) for i, c in x]
    want = []
    for q in (0, 50):
        score = sorted((-int(a @ b), i) for j, a in v if j == q for i, b in v if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(score)]
    assert sorted(tuple(r) for r in V.top_k(df, F.col("id") % 50 == 0).collect()) == want


def test_graph_search_recall_and_scores(spark, vectors):
    data = usable(zero=False)
    got: dict = {}
    for r in G.search(vectors, F.col("id") % 50 == 0, shard_rows=200).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in data:
        if q % 50 == 0:
            cos = {i: float(data[q] @ v / np.sqrt((data[q] @ data[q]) * (v @ v))) for i, v in data.items() if i != q}
            best = sorted(cos, key=lambda i: (-round(cos[i], 12), i))[:5]
            mine = sorted(got[q])
            assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
            assert all(abs(s - cos[i]) < 1e-12 for _, i, s in mine)
            assert all(a[2] >= b[2] for a, b in zip(mine, mine[1:]))
            hits, total = hits + len(set(best) & {i for _, i, _ in mine}), total + 5
    assert set(got) == {q for q in data if q % 50 == 0} and hits / total >= 0.9


def test_given_embeddings_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = {r.vec_id: np.array(r.embedding, float) for r in e.collect()}
    ids = np.array(sorted(x))
    u = G.unit_rows(np.stack([x[i] for i in ids]))
    got: dict = {}
    for r in G.op10_graphann(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, mine in got.items():
        s = u @ u[np.searchsorted(ids, q)]
        s[np.searchsorted(ids, q)] = -9
        hits += len(mine & set(ids[np.argsort(-s, kind="stable")[:5]].tolist()))
    assert hits / (5 * len(got)) >= 0.9


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert V.top_k(few, F.col("id") % 50 == 0).count() == 4
    assert G.search(few, F.col("id") % 50 == 0).count() == 4
    none = few.limit(0)
    assert V.top_k(none, F.col("id") % 50 == 0).count() == 0
    assert G.search(none, F.col("id") % 50 == 0).count() == 0


def test_pruned_graph_is_connected_and_bounded():
    rng = np.random.default_rng(4)
    x = G.unit_rows(rng.normal(size=(600, 16))).astype(np.float32)
    edges, start = G.build(x, degree=12, beam=32)
    assert edges.shape == (600, 12) and (edges[np.arange(600)] != np.arange(600)[:, None]).all()
    seen, todo = {start}, [start]
    while todo:
        for j in edges[todo.pop()].tolist():
            if j >= 0 and j not in seen:
                seen.add(j)
                todo.append(j)
    assert len(seen) >= 595
