"""Classifier metrics as Spark aggregates.

Loss and accuracy are plain ``avg`` aggregates over per-row expressions, so
they run with partial (map-side) aggregation and one tiny final merge no
matter how large the table is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowline.functions.columns import (array_argmax, cross_entropy, dot,
                                        prefixed_metric_map)


def dense_logits(features, weights, bias=None) -> Column:
    """``X.W + b`` for one row as an array column, with the weights as literal
    arrays (a head of a few thousand numbers).  ``weights`` is a list of K
    per-class lists of length D."""
    b = bias if bias is not None else [0.0] * len(weights)
    return F.array(*[dot(features, wk) + F.lit(float(bk)) for wk, bk in zip(weights, b)])


def sine_weights(num_features: int, num_classes: int) -> list[list[float]]:
    """A fixed, closed-form head ``w[k][pos] = sin(k*D + pos)`` used to check
    scoring and metrics independently of any fit."""
    return [[math.sin(k * num_features + p) for p in range(num_features)]
            for k in range(num_classes)]


def sine_logits(features, num_features: int, num_classes: int) -> Column:
    """Same head computed by the JVM (``sin`` evaluated in the plan)."""
    def class_weights(k):
        # one-argument lambda: F.transform treats a second argument as the index
        return F.transform(F.sequence(F.lit(0), F.lit(num_features - 1)),
                           lambda i: F.sin((F.lit(k * num_features) + i).cast("double")))

    cols = []
    for k in range(num_classes):
        w = class_weights(k)
        cols.append(F.aggregate(F.zip_with(F.col(features) if isinstance(features, str) else features,
                                           w, lambda x, y: x.cast("double") * y),
                                F.lit(0.0).cast("double"), lambda s, v: s + v))
    return F.array(*cols)


def loss_and_accuracy(df: DataFrame, logits: str = "logits", label_idx: str = "label_idx",
                      digits: int | None = 6) -> DataFrame:
    """Mean cross-entropy from logits and accuracy over the whole table."""
    loss = F.avg(cross_entropy(logits, label_idx))
    acc = F.avg((array_argmax(logits) == F.col(label_idx)).cast("double"))
    if digits is not None:
        loss, acc = F.round(loss, digits), F.round(acc, digits)
    return df.agg(loss.alias("loss"), acc.alias("accuracy"),
                  F.count(F.lit(1)).alias("n_rows"))


def shard_metrics(df: DataFrame, shard: str = "shard", logits: str = "logits",
                  label_idx: str = "label_idx") -> DataFrame:
    """Per-shard sums that both averages below are computed from."""
    return df.groupBy(shard).agg(
        F.sum(cross_entropy(logits, label_idx)).alias("loss_sum"),
        F.sum((array_argmax(logits) == F.col(label_idx)).cast("double")).alias("correct"),
        F.count(F.lit(1)).alias("n"))


def metric_average(per_shard: DataFrame, weighted: bool = True, digits: int = 6) -> DataFrame:
    """Average of per-worker metrics.  ``weighted`` divides global sums by
    the global count (exact for unequal shards); otherwise the plain mean of
    per-shard means, as a worker-level all-reduce of averages gives."""
    if weighted:
        loss = F.sum("loss_sum") / F.sum("n")
        acc = F.sum("correct") / F.sum("n")
    else:
        loss = F.avg(F.col("loss_sum") / F.col("n"))
        acc = F.avg(F.col("correct") / F.col("n"))
    return per_shard.agg(F.round(loss, digits).alias("loss"), F.round(acc, digits).alias("accuracy"))


def prefixed_metrics(metrics: DataFrame, names=("loss", "accuracy"), prefix: str = "val_") -> DataFrame:
    """One row per metric named ``<prefix><name>``."""
    m = prefixed_metric_map(list(names), [F.col(n) for n in names], prefix)
    return metrics.select(F.explode(m).alias("metric", "value"))


def final_metric(run_metrics: DataFrame, run: str = "run_id", key: str = "key",
                 step: str = "step", value: str = "value") -> DataFrame:
    """Last logged value of each metric of each run (history[-1])."""
    return run_metrics.groupBy(run, key).agg(
        F.max_by(F.col(value), F.col(step)).alias("value"),
        F.max(step).alias("last_step"))
