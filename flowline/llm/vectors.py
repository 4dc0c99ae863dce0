"""Vectors as rows of binary: what the two search operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): x the components as doubles in bytes, of the rows that can
    take part: an id, and a vector of the most common length (the smaller of
    equally common ones) without null or non-finite components."""
    x = F.col(vec_col).cast("array<double>")
    clean = rows.select(F.col(id_col).cast("bigint").alias("id"), x.alias("x")).filter(
        F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).filter(
        F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)))
    common = (clean.groupBy(F.size("x").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect())
    length = common[0]["n"] if common else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                flat = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array([v.tobytes() for v in flat + 0.0], pa.binary())], names=["id", "x"])

    return clean.filter(F.size("x") == length).mapInArrow(run, "id long, x binary")


def matrix(column) -> np.ndarray:
    """Rows of doubles from a binary column."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.float64).reshape(len(parts), -1)
