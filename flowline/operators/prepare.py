"""Refining rows into training tables: sample, split, vocabulary, indexes.

Every random choice is a hash of a stable key, so results do not depend on
partitioning, retries or the number of executors (``randomSplit`` and
``sample`` are kept for parity with the original workflow).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowline.functions.columns import hash_unit, label_from_path


# ---------------------------------------------------------------- labels
def with_label_from_path(df: DataFrame, path_col: str = "path", out: str = "label") -> DataFrame:
    """Silver step: the label is the parent directory of the file."""
    return df.withColumn(out, label_from_path(path_col))


# ---------------------------------------------------------------- sampling
def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "sample") -> DataFrame:
    """Bernoulli-like sample that keeps the same rows on every run."""
    return df.filter(hash_unit(key, salt) < F.lit(float(fraction)))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    # Keywords on purpose: a positional fraction with a keyword seed loses
    # the seed in this PySpark version.
    return df.sample(fraction=fraction, seed=seed)


# ---------------------------------------------------------------- splits
def split_column(key: str, weights=(0.9, 0.1), names=("train", "val"),
                 salt: str = "split") -> Column:
    """Name of the split each row falls in, from cumulative weight bounds."""
    if len(weights) != len(names) or not weights or any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError("one non-negative weight per split name, with a positive total")
    total = float(sum(weights))
    u = hash_unit(key, salt)
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    expr = F.lit(names[-1])
    for b, n in reversed(list(zip(bounds, names))):
        expr = F.when(u < F.lit(b), F.lit(n)).otherwise(expr)
    return expr


def hash_split(df: DataFrame, key: str, weights=(0.9, 0.1), salt: str = "split") -> list[DataFrame]:
    names = [str(i) for i in range(len(weights))]
    tagged = df.withColumn("_split", split_column(key, weights, names, salt))
    return [tagged.filter(F.col("_split") == n).drop("_split") for n in names]


def random_split(df: DataFrame, weights=(0.9, 0.1), seed: int = 42) -> list[DataFrame]:
    """Parity with ``randomSplit``; depends on physical layout."""
    return df.randomSplit(list(weights), seed=seed)


def split_partition_check(whole: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    """One row (missing_rows, duplicate_rows, extra_rows): all zero when the
    parts are a partition of ``whole``.  One shuffle on the (unique) key."""
    tagged = parts[0].select(key)
    for p in parts[1:]:
        tagged = tagged.unionByName(p.select(key))
    seen = tagged.groupBy(key).agg(F.count(F.lit(1)).alias("_times"))
    w = whole.select(F.col(key).alias("_wk"))
    j = w.join(seen, w["_wk"] == seen[key], "full_outer")
    return j.agg(
        F.sum(F.when(F.col("_times").isNull(), 1).otherwise(0)).cast("bigint").alias("missing_rows"),
        F.sum(F.when(F.col("_times") > 1, F.col("_times") - 1).otherwise(0)).cast("bigint").alias("duplicate_rows"),
        F.sum(F.when(F.col("_wk").isNull(), 1).otherwise(0)).cast("bigint").alias("extra_rows"))


# ---------------------------------------------------------------- vocabulary
def distinct_labels(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.select(label_col).where(F.col(label_col).isNotNull()).distinct()


def num_classes(df: DataFrame, idx_col: str = "label_idx") -> DataFrame:
    return df.agg(F.count_distinct(idx_col).alias("num_classes"))


def build_vocab(df: DataFrame, label_col: str = "label", idx_col: str = "label_idx") -> DataFrame:
    """Sorted labels numbered from 0: ``{l: i for i, l in enumerate(sorted(labels))}``.

    One lazy plan: the distinct labels (one row per class, partial aggregation
    over the data) are numbered by a window over these few rows."""
    number = F.row_number().over(Window.orderBy(label_col)) - 1
    return distinct_labels(df, label_col).select(label_col, number.cast("int").alias(idx_col))


def index_labels(df: DataFrame, vocab: DataFrame, label_col: str = "label",
                 idx_col: str = "label_idx", handle_unseen: str = "error") -> DataFrame:
    """Attach ``label_idx`` by an equi-join with the vocabulary.

    handle_unseen: ``error`` fails the job on a label missing from the
    vocabulary (like a dictionary lookup), ``skip`` drops such rows,
    ``keep`` gives them index ``len(vocab)``."""
    v = vocab.select(F.col(label_col).alias("_vl"), F.col(idx_col).alias("_vi"))
    how = "inner" if handle_unseen == "skip" else "left"
    j = df.join(v, df[label_col] == v["_vl"], how)
    if handle_unseen == "error":
        idx = F.when(F.col("_vi").isNull(),
                     F.raise_error(F.concat(F.lit("label not in vocabulary: "),
                                            F.coalesce(F.col(label_col).cast("string"), F.lit("NULL")))))\
               .otherwise(F.col("_vi"))
    elif handle_unseen == "keep":
        idx = F.coalesce(F.col("_vi"), vocab.agg(F.count(F.lit(1))).scalar().cast("int"))
    elif handle_unseen == "skip":
        idx = F.col("_vi")
    else:
        raise ValueError(f"handle_unseen must be error, skip or keep, not {handle_unseen!r}")
    return j.withColumn(idx_col, idx.cast("int")).drop("_vl", "_vi")


def unseen_labels(df: DataFrame, vocab: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows whose label has no vocabulary entry (validation report)."""
    v = vocab.select(F.col(label_col).alias("_vl"))
    return df.join(v, df[label_col] == v["_vl"], "left_anti")


def index_to_label(df: DataFrame, vocab: DataFrame, idx_col: str = "label_idx",
                   out: str = "label") -> DataFrame:
    v = vocab.select(F.col(idx_col).alias("_vi"), F.col("label").alias(out))
    return df.join(v, df[idx_col] == v["_vi"], "left").drop("_vi")
