import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowline.llm import periodic as R


def numbers(docs):
    seen = {}
    return [np.array([seen.setdefault(w, len(seen) + 1) for w in d], np.int64) for d in docs]


@given(st.lists(st.lists(st.sampled_from("ab"), max_size=70), max_size=6), st.sampled_from([(6, 4), (2, 2), (5, 3)]))
@settings(max_examples=200, deadline=None)
def test_two_words(docs, rule):
    assert R.find_runs(numbers(docs), *rule) == [R.brute_force(d, *rule) for d in docs]


@given(st.lists(st.tuples(st.lists(st.integers(0, 5), min_size=1, max_size=9), st.integers(1, 40)), max_size=6))
@settings(max_examples=150, deadline=None)
def test_repeated_blocks(parts):
    words = [w for block, times in parts for w in block * times]
    docs = [words, words[3:], [9, *words], words[::-1]]
    assert R.find_runs(numbers(docs)) == [R.brute_force(d) for d in docs]


def test_long_periods_and_copies():
    rng = random.Random(3)
    block = [rng.randrange(10 ** 6) for _ in range(700)]
    one = block * 5 + [1] + block * 4 + block[:20] + [2, 2, 2, 2, 2, 2, 2]
    docs = [one, one, block, [], [7] * 3000, block[:100] * 30]
    assert R.find_runs(numbers(docs)) == [R.brute_force(d) for d in docs]


@given(st.lists(st.integers(0, 1), min_size=1, max_size=300))
@settings(max_examples=100, deadline=None)
def test_extensions(words):
    x = np.array([*words, 9], np.int64)
    ext = R.Extensions(x)
    i, j = np.meshgrid(np.arange(len(x)), np.arange(len(x)))
    i, j = i[i != j], j[i != j]
    k = np.random.default_rng(1).integers(0, len(i), 200) if len(i) else np.zeros(0, int)
    for a, b, got in zip(i[k], j[k], ext(i[k], j[k])):
        n = 0
        while max(a, b) + n < len(x) and x[a + n] == x[b + n]:
            n += 1
        assert got == n


def test_cover():
    assert R.SHIFTS.max() < R.MODULUS and len(R.COVER) ** 2 - len(R.COVER) + 1 == R.MODULUS


def expected(doc_id, text):
    words = R.repeated_tail(doc_id, (text or "").encode().split())
    runs = R.brute_force(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def digests(spark, df, monkeypatch):
    monkeypatch.setattr(R, "table", lambda *_: df)
    return [tuple(r) for r in R.op12_periodic(spark, "").collect()]


@pytest.mark.parametrize("chunk", [4_000_000, 50])
def test_documents_equal_brute_force(spark, docs, monkeypatch, chunk):
    monkeypatch.setattr(R, "GRID", chunk)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = [expected(*r) if len(r[1] or "") < 50_000 else (r[0],) for r in rows]
    got = [r if r[0] != 6 else (6,) for r in digests(spark, docs, monkeypatch)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[1] for r in got if len(r) > 1)


def test_small_table_equals_brute_force(spark, small, monkeypatch):
    got = {r[0]: r for r in digests(spark, small, monkeypatch)}
    rows = [(r.doc_id, r.text) for r in small.collect() if len((r.text or "").split()) < 1500]
    assert len(rows) > 150 and all(got[i] == expected(i, t) for i, t in rows)


def test_very_long_text_hot_rows_and_empty_table(spark, no_docs, monkeypatch):
    assert digests(spark, no_docs, monkeypatch) == []
    text = "same " * 200_000
    df = spark.createDataFrame([(1, text)] + [(2, "x y " * 20)] * 200, "doc_id long, text string").repartition(4)
    out = R.collapse_runs(df).collect()
    assert sorted((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.kept_text) for r in out) == \
        [(1, 200_000, ((0, 200_000, 1),), "same")] + [(2, 40, ((0, 40, 2),), "x y")] * 200


def test_rule_needs_a_period():
    with pytest.raises(ValueError):
        R.find_runs([], 6, 1)
