"""Toxicity: a linear classifier over character n-grams, each scaled by its
naive Bayes log-count ratio.

Features say whether an n-gram (4 to 6 bytes of the lower-cased text) occurs,
hashed into 2**18 cells.  Training reads a bounded sample of labelled rows:

1. the ``max_train`` labelled documents with the smallest hash of doc_id; of
   several rows of one doc_id, the text with the smallest hash;
2. documents of either class that hold a cell, counted by Spark;
3. r = log of the ratio of the two classes' smoothed frequencies; cells whose
   r stands out from chance by ``MIN_Z`` standard errors are features;
4. logistic regression with an L2 penalty on x = r * presence.

Scoring maps over the documents without a shuffle.

Nulls and ties: a null text counts as empty; an empty text gets the score of
the bias.  Label rows with a null label are ignored; of several labels of one
document the largest holds.  Without labels, or with one class only, the
score is a smoothed base rate.  A null doc_id is scored and never held out.
Repeated rows each get the same score.  ``labels`` gives nothing but the
training target; lang, source and doc_id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm.common import staged, table

DIMS = 1 << 18
ORDERS = (4, 5, 6)
MAX_TRAIN = 8_000        # labelled rows to learn from
MAX_FEATURES = 20_000
MIN_Z = 4.0
L2 = 1e-3
THRESHOLD = 0.3


def cells(text: str | None) -> np.ndarray:
    """Cells of all n-grams of the text, with repeats."""
    raw = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "surrogatepass") + b" ", np.uint8).astype(np.uint32)
    out, h = [], raw
    for n in range(2, ORDERS[-1] + 1):
        if len(raw) < n:
            break
        h = h[:len(raw) - n + 1] * np.uint32(0x01000193) + raw[n - 1:]
        if n in ORDERS:
            x = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            out.append((x ^ (x >> np.uint32(13))) & np.uint32(DIMS - 1))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, text, toxic): at most ``max_train`` labelled documents, one row
    for each doc_id."""
    chosen = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~is_held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    # max_train ids at most; every task merges the rows of an id before they are dealt
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
            .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("row")))
    return staged(rows.select("doc_id", "row.text", "toxic"), "toxic_sample")


def _counts(sample: DataFrame) -> pd.DataFrame:
    """cell, pos, neg: documents of either class with the cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, DIMS), np.int64)
        for b in batches:
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                total[1 if y else 0, np.unique(cells(text))] += 1
        seen = np.flatnonzero(total.sum(axis=0))
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[1, seen]),
                                              pa.array(total[0, seen])], names=["cell", "pos", "neg"])

    # at most DIMS rows reach the driver
    return (sample.select("text", "toxic").mapInArrow(run, "cell long, pos long, neg long")
            .groupBy("cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
            .filter("pos + neg >= 3").toPandas())


def _logistic(x: np.ndarray, rows: np.ndarray, cols: np.ndarray, y: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent with a step from the curvature
    bound and Nesterov's momentum; x holds the non-zero entries."""
    n = len(y)
    lip = 0.25 * np.bincount(rows, x * x, n).max(initial=1.0) + 0.25 + L2
    w, b = np.zeros(width), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    vw, vb, t = w, b, 1.0
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, x * vw[cols], n) + vb, -30, 30)))
        g = (p - y) / n
        nw = vw - (np.bincount(cols, x * g[rows], width) + L2 / n * vw) * n / (lip * 50)
        nb = vb - g.sum() * n / (lip * 50)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / s * (nw - w), nb + (t - 1) / s * (nb - b)
        w, b, t = nw, nb, s
    return w, b


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """(weight per cell, bias)."""
    weights = np.zeros(DIMS, np.float32)
    sample = training_sample(docs, labels, max_train)
    both = {r["toxic"] != 0: r["count"] for r in sample.groupBy((F.col("toxic") != 0).cast("int").alias("toxic"))
            .count().collect()}
    pos, neg = both.get(True, 0), both.get(False, 0)
    if not pos or not neg:
        rate = (pos + 0.1) / (pos + neg + 1)
        return weights, float(np.log(rate / (1 - rate)))
    c = _counts(sample)
    p, q = c["pos"].to_numpy() + 1.0, c["neg"].to_numpy() + 1.0
    ratio = np.log(p / (pos + 2)) - np.log(q / (neg + 2))
    z = np.abs(ratio) / np.sqrt(1 / p + 1 / q)
    order = np.lexsort((c["cell"].to_numpy(), -z))[:MAX_FEATURES]
    chosen = order[z[order] >= MIN_Z]
    cell = np.sort(c["cell"].to_numpy()[chosen])
    r = pd.Series(ratio, index=c["cell"].to_numpy()).loc[cell].to_numpy()

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(DIMS, bool)
        wanted[cell] = True
        for b in batches:
            found = []
            for text in b.column("text").to_pylist():
                x = cells(text)
                found.append(np.searchsorted(cell, np.unique(x[wanted[x]])).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic").cast(pa.int32()),
                                              pa.array(found, pa.binary())], names=["doc_id", "toxic", "found"])

    # bounded by max_train documents and MAX_FEATURES cells
    rows = sample.mapInArrow(entries, "doc_id long, toxic int, found binary").collect()
    rows = sorted(rows, key=lambda t: (t["doc_id"], bytes(t["found"])))
    found = [np.frombuffer(t["found"], np.int32) for t in rows]
    cols = np.concatenate(found) if found else np.zeros(0, np.int32)
    at = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    y = np.array([1.0 if t["toxic"] else 0.0 for t in rows])
    w, bias = _logistic(r[cols], at, cols, y, len(cell))
    weights[cell] = (w * r).astype(np.float32)
    return weights, bias


def scorer(spark: SparkSession, model: tuple[np.ndarray, float]):
    """The model as a column function of the text."""
    shared, bias = spark.sparkContext.broadcast(model[0]), model[1]      # 1 MB

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        w = shared.value
        used = w != 0
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            x = cells(text)
            out[k] = bias + w[np.unique(x[used[x]])].sum(dtype=np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted for each document."""
    score = scorer(docs.sparkSession, train(docs, labels, max_train))
    return (docs.select("doc_id", is_held_out().alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_clean(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The documents below the threshold, with their columns."""
    score = scorer(docs.sparkSession, train(docs, labels, max_train))
    return docs.filter(score(docs["text"]) < THRESHOLD)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents``, learnt from ``labels``."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
