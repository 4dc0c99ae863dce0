import pytest
from pyspark.sql import functions as F

from flowline.operators import prepare


def _ids(df, col="id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_hash_split_is_partition_and_layout_free(spark):
    base = spark.range(2000)
    ref = None
    for n in (1, 2, 7):
        tr, va = prepare.hash_split(base.repartition(n), "id", (0.9, 0.1))
        t, v = _ids(tr), _ids(va)
        assert not set(t) & set(v) and len(t) + len(v) == 2000
        assert ref is None or ref == (t, v)
        ref = (t, v)
        chk = prepare.split_partition_check(base, [tr, va], "id").first()
        assert (chk.missing_rows, chk.duplicate_rows, chk.extra_rows) == (0, 0, 0)


def test_adding_rows_keeps_assignment(spark):
    small_tr, _ = prepare.hash_split(spark.range(500), "id")
    big_tr, _ = prepare.hash_split(spark.range(1000), "id")
    assert set(_ids(small_tr)) <= set(_ids(big_tr))


def test_vocab_sorted_contiguous(spark):
    df = spark.createDataFrame([(l,) for l in "delta_ gamma alpha gamma alpha epsilon".split()] + [(None,)],
                               "label string")
    v = prepare.build_vocab(df)
    rows = v.orderBy("label_idx").collect()
    assert [r.label for r in rows] == ["alpha", "delta_", "epsilon", "gamma"]
    assert [r.label_idx for r in rows] == [0, 1, 2, 3]


def test_unseen_policies(spark):
    train = spark.createDataFrame([("a",), ("b",)], "label string")
    val = spark.createDataFrame([(1, "a"), (2, "c")], "id int, label string")
    vocab = prepare.build_vocab(train)
    with pytest.raises(Exception, match="label not in vocabulary"):
        prepare.index_labels(val, vocab, handle_unseen="error").collect()
    assert {r.id: r.label_idx for r in prepare.index_labels(val, vocab, handle_unseen="keep").collect()} == {1: 0, 2: 2}
    assert [r.id for r in prepare.index_labels(val, vocab, handle_unseen="skip").collect()] == [1]
    assert [r.id for r in prepare.unseen_labels(val, vocab).collect()] == [2]
    back = prepare.index_to_label(prepare.index_labels(val, vocab, handle_unseen="skip"), vocab, out="back")
    assert back.first().back == "a"


def test_seeded_bernoulli_sample_is_stable(spark):
    df = spark.range(1000)
    a = prepare.bernoulli_sample(df, 0.5, seed=3).count()
    b = prepare.bernoulli_sample(df, 0.5, seed=3).count()
    assert a == b
    assert abs(prepare.hash_sample(df, "id", 0.5).count() - 500) < 60


def test_vocab_independent_of_partitions(spark):
    rows = [(f"l{i % 13}",) for i in range(500)]
    base = spark.createDataFrame(rows, "label string")
    ref = sorted(tuple(r) for r in prepare.build_vocab(base).collect())
    for n in (1, 2, 7):
        assert sorted(tuple(r) for r in prepare.build_vocab(base.repartition(n)).collect()) == ref


def test_split_validates_weights(spark):
    import pytest as _pt
    with _pt.raises(ValueError):
        prepare.split_column("id", (0.9, 0.1), ("only",))
    with _pt.raises(ValueError):
        prepare.split_column("id", (0.0, 0.0), ("a", "b"))
    parts = prepare.hash_split(spark.range(3000), "id", (0.8, 0.1, 0.1))
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 3000 and sizes[0] > sizes[1] and sizes[0] > sizes[2]
