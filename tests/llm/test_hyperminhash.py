import numpy as np
import pytest

from flowline.llm import hyperminhash as H
from tests.llm.conftest import by_id


def brute(rows, size, percent):
    """doc_id -> (set size, smallest doc_id reachable), by all pairs."""
    ids = [i for i, _ in rows]
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size
                    else ({tuple(w)} if w else set()))
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                if a != b:
                    low, high = sorted((a, b), key=lambda k: ids[k])
                    parent[high] = low
    return {ids[i]: (len(sets[i]), ids[find(i)]) for i in range(len(ids))}


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").distinct().collect() if r.doc_id is not None]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(docs, size, percent):
    got = by_id(H.near_duplicates(docs, size, percent))
    want = brute(pairs(docs), size, percent)
    assert {k: (v["n_shingles"], v["component_id"]) for k, v in got.items() if k is not None} == want
    assert all(v["kept"] == (k == v["component_id"]) for k, v in got.items() if k is not None)
    assert got[None]["kept"]


def test_small_table_equals_all_pairs(small):
    got = by_id(H.near_duplicates(small, 3, 85))
    assert {k: (v["n_shingles"], v["component_id"]) for k, v in got.items()} == brute(pairs(small), 3, 85)


def test_chains_join_what_no_band_representative_links(spark):
    """A chain of texts, each near only to its neighbours, is one component."""
    words = [f"w{k}" for k in range(1000)]
    rows = [(k, " ".join(words[k * 6:k * 6 + 100])) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(H.near_duplicates(df, 3, 85))
    assert {v["component_id"] for v in got.values()} == {0}


def test_deduplicated_keeps_columns_and_one_of_each_group(docs):
    out = H.deduplicated(docs, 3, 85)
    assert out.columns == docs.columns
    rows = out.select("doc_id", "text").collect()
    want = brute(pairs(docs), 3, 85)
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(k for k, v in want.items() if v[1] == k)
    assert sum(r.doc_id is None for r in rows) == 1


def test_empty_table(no_docs):
    assert H.near_duplicates(no_docs, 3, 85).count() == 0
    assert H.deduplicated(no_docs).columns == no_docs.columns


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        err = []
        for _ in range(60):
            both = rng.integers(0, 2 ** 63, int(300 * share), dtype=np.uint64) * np.uint64(2)
            rest = rng.integers(0, 2 ** 63, 300 - len(both), dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(np.concatenate([both, rest[::2]])), np.unique(np.concatenate([both, rest[1::2]]))
            err.append(H.estimate(H.signature(a), H.signature(b)) - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(err)) < 0.03 and np.std(err) < H.DEVIATION * 1.6
