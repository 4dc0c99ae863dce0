"""Table sinks and sources: managed tables, databases, snapshots, weights.

Tables default to Parquet; the format is a parameter (a lake format can be
passed when its jars are on the classpath).  Compression is chosen per write,
never session-wide: image bytes are already compressed, so bronze tables are
written uncompressed.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark import StorageLevel

from flowline.session import scratch_path


# ---------------------------------------------------------------- databases
CREATED_BY_US = "flowline.created"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database tagged as ours (a database property), so a later
    cascade drop can prove it only removes what this package created."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc} "
              f"WITH DBPROPERTIES ('{CREATED_BY_US}' = 'true')")


def created_by_us(spark: SparkSession, name: str) -> bool:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED `{name}`").collect()     # a few rows
    props = " ".join(str(v) for r in rows for v in r)
    return CREATED_BY_US in props


def drop_database(spark: SparkSession, name: str, cascade: bool = False, force: bool = False) -> None:
    """Drop a database.  ``cascade`` must be asked for explicitly, and is
    refused on a database this package did not create unless ``force``."""
    if cascade and not force and spark.catalog.databaseExists(name) and not created_by_us(spark, name):
        raise PermissionError(f"refusing DROP ... CASCADE of {name!r}: not created by flowline")
    spark.sql(f"DROP DATABASE IF EXISTS `{name}`{' CASCADE' if cascade else ''}")


# ---------------------------------------------------------------- tables
def save_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
               compression: str | None = None, path: str | None = None,
               partition_by: list[str] | None = None) -> None:
    """``df.write.format(fmt).mode(mode).saveAsTable(name)`` with the codec as a
    per-write option and an optional external location."""
    w = df.write.format(fmt).mode(mode)
    if compression:
        w = w.option("compression", compression)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def sql_scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {name}")


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """A bounded look at a table; ordered when a stable answer matters."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


# ---------------------------------------------------------------- snapshots
class Snapshot:
    """A DataFrame materialised once under the shared checkpoint folder, its
    length known, cached for the many passes of a training loop.

    Lineage is cut by the write: a lost executor re-reads files instead of
    recomputing the upstream plan.  ``release`` (or leaving the ``with``
    block) unpersists and deletes the files."""

    def __init__(self, df: DataFrame, path: str | None = None, cache: bool = True,
                 compression: str | None = None, written: bool = False,
                 owned_paths: list | None = None):
        """``written=True``: ``df`` already reads from files written under the
        checkpoint folder (lineage already cut); only cache and count.
        ``owned_paths`` are deleted on release as well."""
        self.spark = df.sparkSession
        self.owned = list(owned_paths or [])
        self.path = None if written else (path or scratch_path(self.spark, "snapshot"))
        if written:
            self.df = df
        else:
            w = df.write.mode("overwrite")
            if compression:
                w = w.option("compression", compression)
            w.parquet(self.path)
            self.df = self.spark.read.parquet(self.path)
        if cache:
            self.df = self.df.persist(StorageLevel.MEMORY_AND_DISK)
        self.count = self.df.count()

    def __len__(self) -> int:
        return self.count

    def release(self) -> None:
        self.df.unpersist()
        for p in ([self.path] if self.path else []) + self.owned:
            delete_path(self.spark, p)

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.release()
        return False


# ---------------------------------------------------------------- model weights
WEIGHTS_SCHEMA = "run_id string, k int, pos int, w double"


def weights_frame(spark: SparkSession, run_id: str, weights: np.ndarray,
                  bias: np.ndarray, epoch: int | None = None) -> DataFrame:
    """Long form of a (D, K) head plus bias (pos = D)."""
    D, K = weights.shape
    full = np.vstack([weights, bias[None, :]])
    pos, k = np.meshgrid(np.arange(D + 1), np.arange(K), indexing="ij")
    pdf = pd.DataFrame({"run_id": run_id, "k": k.ravel().astype("int32"),
                        "pos": pos.ravel().astype("int32"), "w": full.ravel()})
    if epoch is not None:
        pdf.insert(1, "epoch", np.int32(epoch))
    return spark.createDataFrame(pdf)


def save_weights(spark: SparkSession, path: str, run_id: str, weights: np.ndarray,
                 bias: np.ndarray, mode: str = "append") -> None:
    weights_frame(spark, run_id, weights, bias).write.mode(mode).partitionBy("run_id").parquet(path)


def weights_from_rows(rows, num_features: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    rows = list(rows)
    D = num_features if num_features is not None else max(r["pos"] for r in rows)
    K = max(r["k"] for r in rows) + 1
    full = np.zeros((D + 1, K))
    for r in rows:
        full[r["pos"], r["k"]] = r["w"]
    return full[:D], full[D]


def load_weights(spark: SparkSession, path: str, run_id: str) -> tuple[np.ndarray, np.ndarray]:
    """Read one run's head back (bounded: model-sized)."""
    rows = (spark.read.parquet(path).filter(F.col("run_id") == run_id)
                 .select("k", "pos", "w").collect())
    if not rows:
        raise KeyError(f"no weights for run {run_id}")
    return weights_from_rows([r.asDict() for r in rows])


# ---------------------------------------------------------------- epoch checkpoints
def save_checkpoint(spark: SparkSession, path: str, run_id: str, epoch: int,
                    weights: np.ndarray, bias: np.ndarray) -> None:
    (weights_frame(spark, run_id, weights, bias, epoch=epoch)
     .write.mode("append").partitionBy("run_id", "epoch").parquet(path))


def latest_checkpoint(spark: SparkSession, path: str, run_id: str):
    """(epoch, weights, bias) of the newest checkpoint of a run, or None."""
    ck = spark.read.parquet(path).filter(F.col("run_id") == run_id)
    last = ck.agg(F.max("epoch")).first()[0]
    if last is None:
        return None
    rows = ck.filter(F.col("epoch") == last).select("k", "pos", "w").collect()
    w, b = weights_from_rows([r.asDict() for r in rows])
    return int(last), w, b


STATE_SCHEMA = "run_id string, epoch int, weights binary, m binary, v binary, shape array<int>, rest string"


def save_state(spark: SparkSession, path: str, run_id: str, epoch: int, state: dict) -> None:
    """The whole state of a fit after an epoch (``fit_many``'s ``states``):
    weights, optimizer moments, history, plateau and stop (model-sized)."""
    opt = state["optimizer"]
    rest = json.dumps({"t": opt["t"], "history": state["history"], "plateau": state["plateau"],
                       "stopped": state["stopped"]})
    row = (run_id, int(epoch), bytearray(state["weights"].tobytes()), bytearray(opt["m"].tobytes()),
           bytearray(opt["v"].tobytes()), list(state["weights"].shape), rest)
    spark.createDataFrame([row], STATE_SCHEMA).write.mode("append").parquet(path)


def latest_state(spark: SparkSession, path: str, run_id: str):
    """(epoch, state) of a run's newest stored epoch, or None."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    row = (spark.read.schema(STATE_SCHEMA).parquet(path).filter(F.col("run_id") == run_id)
           .orderBy(F.col("epoch").desc()).first())
    if row is None:
        return None
    rest = json.loads(row["rest"])

    def array(name):
        return np.frombuffer(bytes(row[name])).reshape(row["shape"])

    return row["epoch"], {"weights": array("weights"), "history": rest["history"], "plateau": rest["plateau"],
                          "stopped": rest["stopped"],
                          "optimizer": {"t": rest["t"], "m": array("m"), "v": array("v")}}
