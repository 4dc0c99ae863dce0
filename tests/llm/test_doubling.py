import random

import pytest

from flowline.llm import doubling as D
from tests.llm.conftest import by_id


def run(df, length, start):
    from pyspark.sql import functions as F
    out = D.remove_repeats(df, length, start).withColumn("sha", F.sha2("kept_text", 256)).drop("kept_text")
    return {k: (v["n_words"], v["n_removed"], v["sha"]) for k, v in by_id(out).items()}


@pytest.mark.parametrize("length,start", [(20, 5), (10, 10), (7, 3)])
def test_equals_brute_force(docs, length, start):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id is not None]
    got = run(docs, length, start)
    assert got.pop(None)[:2] == (3, 0)
    assert got == D.brute_force(rows, length)


def test_small_table_equals_brute_force(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert run(small, 20, 5) == D.brute_force(rows, 20)


def test_repeats_in_few_words(spark, monkeypatch):
    """Few different words, small chunks: repeats within and across chunks."""
    monkeypatch.setattr(D, "CHUNK_WORDS", 50)
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert run(df, 8, 2) == D.brute_force(rows, 8)


def test_empty_table_and_no_candidates(spark, no_docs):
    assert D.remove_repeats(no_docs).count() == 0
    df = spark.createDataFrame([(1, " ".join(map(str, range(50))))], "doc_id long, text string")
    assert run(df, 20, 5)[1][1] == 0


def test_levels():
    assert D.levels(20, 5) == [5, 10, 20] and D.levels(7, 3) == [7] and D.levels(32, 4) == [4, 8, 16, 32]


def test_a_third_of_all_rows_equal(spark):
    """Equal rows of one doc_id: none removes the other, and a position is
    kept once, not once a row."""
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(1, text)] * 1_500 + [(2, text)] + [(k, f"{k} a b c " * 10) for k in range(3, 1_500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    marks = D.repeated_windows(df)
    assert max(len(r.marks) // 4 for r in marks.filter("doc_id <= 2").collect()) <= 81
    out = D.remove_repeats(df)
    got = {tuple(r) for r in out.filter("doc_id <= 2").select("doc_id", "n_words", "n_removed").collect()}
    assert got == {(1, 100, 0), (2, 100, 100)} and out.count() == len(rows)


def test_rows_once_a_task(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(D, "SEEN", 3)
    ids = [1, 1, 2, 3, 1, 2, 4, 4]
    batches = [pa.RecordBatch.from_arrays([pa.array(x), pa.array([7] * len(x))], names=["doc_id", "text_hash"])
               for x in (ids[:2], [], ids[2:5], ids[5:])]
    left = [i for b in D._once(iter(batches)) for i in b.column("doc_id").to_pylist()]
    assert left == [1, 2, 3, 4]
