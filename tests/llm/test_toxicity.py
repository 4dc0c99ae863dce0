import zlib

import numpy as np
import pytest

from flowline.llm import toxicity as T
from tests.llm.conftest import by_id

LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    return T.score_documents(docs, labels).join(labels, "doc_id", "left").toPandas()


def test_held_out_accuracy(scored):
    x = scored[scored.held_out & scored.toxic.notna()]
    y = x.toxic.to_numpy() == 1
    rank = x.score.rank().to_numpy()
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    p = x.predicted.to_numpy() == 1
    assert auc > 0.95 and (p & y).sum() / y.sum() > 0.75 and (p & y).sum() / p.sum() > 0.85


def test_folds_and_range(scored):
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(scored.doc_id, scored.held_out))
    assert scored.score.between(0, 1).all() and (scored.predicted == (scored.score >= 0.3)).all()


def test_held_out_labels_are_not_read(spark, small):
    from pyspark.sql import functions as F
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("toxic", F.when(T.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (by_id(T.score_documents(small, x)) for x in (labels, turned))
    assert a == b


def test_awkward_documents(spark, docs, no_docs):
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(30)] + [(5, None), (3, 1)],
                                   "doc_id long, toxic int")
    got = T.score_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    none = labels.limit(0)
    assert {round(r.score, 6) for r in T.score_documents(docs, none).collect()} == {0.1}
    assert T.keep_clean(docs, none).columns == docs.columns and T.keep_clean(docs, none).count() == docs.count()
    assert T.score_documents(no_docs, none).count() == 0


def test_gradient_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.random((200, 6)) < 0.4
    y = (x[:, 0] | (rng.random(200) < 0.1)).astype(float)
    rows, cols = np.nonzero(x)
    w, b = T._logistic(np.ones(len(rows)), rows, cols, y, 6)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + T.L2 * w).max() < 1.5 and w[0] > 3 * np.abs(w[1:]).max()


def test_sample_has_one_row_per_document(spark):
    from pyspark.sql import functions as F
    rows = [(k, f"text {k}") for k in range(40)] + [(8, f"other {k}") for k in range(300)] + [(9, None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int").filter(~T.is_held_out())
    n = labels.count()
    sample = T.training_sample(docs, labels).collect()
    assert sorted(r.doc_id for r in sample) == sorted(r.doc_id for r in labels.collect())
    assert T.training_sample(docs, labels, n - 3).count() == n - 3
    least = docs.orderBy(F.xxhash64("text"), "text").collect()
    for r in sample:
        assert r.toxic == r.doc_id % 2 and r.text == next(x.text for x in least if x.doc_id == r.doc_id)
