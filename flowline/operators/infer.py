"""Batch scoring with a packaged model.

A ``PackagedModel`` is the head (weights, bias), its class names (the stored
vocabulary, not a hard-coded list) and the preprocessing config shared with
training.  Scoring is ``predict_batch_udf``: the model is loaded once per
Python worker (outer function) and applied to Arrow batches of ``batch_size``
rows (inner function), so it runs in parallel over the whole table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from flowline.sources import tables as TB


@dataclass
class PackagedModel:
    weights: np.ndarray                 # (D, K)
    bias: np.ndarray                    # (K,)
    classes: list                       # class name of index k
    preprocess: dict = field(default_factory=dict)

    @property
    def num_features(self) -> int:
        return int(self.weights.shape[0])

    # ------------------------------------------------------------ scoring
    def make_shared_predict_fn(self, spark: SparkSession, output: str = "label"):
        """As ``make_predict_fn``, with the head in a broadcast: a function's
        pickled plan stays small, and an executor fetches the head once."""
        shared = spark.sparkContext.broadcast((np.asarray(self.weights, np.float64), np.asarray(self.bias, np.float64),
                                               list(self.classes)))

        def make():
            w, b, names = shared.value
            classes = np.asarray(names, dtype=object)

            def predict(x: np.ndarray) -> np.ndarray:
                idx = np.argmax(x.astype(np.float64) @ w + b, axis=1)
                return classes[idx] if output == "label" else idx.astype(np.int32)
            return predict
        return make

    def make_predict_fn(self, output: str = "label"):
        w = np.asarray(self.weights, dtype=np.float64)
        b = np.asarray(self.bias, dtype=np.float64)
        classes = np.asarray(self.classes, dtype=object)

        def make():
            # runs once per Python worker: "load" the model
            def predict(x: np.ndarray) -> np.ndarray:
                idx = np.argmax(x.astype(np.float64) @ w + b, axis=1)
                return classes[idx] if output == "label" else idx.astype(np.int32)
            return predict
        return make

    def udf(self, output: str = "label", batch_size: int = 128):
        rtype = StringType() if output == "label" else IntegerType()
        return predict_batch_udf(self.make_predict_fn(output), return_type=rtype,
                                 batch_size=batch_size, input_tensor_shapes=[[self.num_features]])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(x, dtype=np.float64) @ self.weights + self.bias

    # ------------------------------------------------------------ persistence
    def save(self, spark: SparkSession, path: str, run_id: str = "model") -> None:
        TB.save_weights(spark, f"{path}/weights", run_id, self.weights, self.bias, mode="overwrite")
        meta = spark.createDataFrame(
            [(run_id, json.dumps(self.preprocess, sort_keys=True))], "run_id string, preprocess string")
        meta.write.mode("overwrite").parquet(f"{path}/meta")
        vocab = spark.createDataFrame([(str(c), i) for i, c in enumerate(self.classes)],
                                      "label string, label_idx int")
        vocab.write.mode("overwrite").parquet(f"{path}/vocab")

    @classmethod
    def load(cls, spark: SparkSession, path: str, run_id: str = "model") -> "PackagedModel":
        w, b = TB.load_weights(spark, f"{path}/weights", run_id)
        meta = spark.read.parquet(f"{path}/meta").filter(F.col("run_id") == run_id).first()
        vocab = spark.read.parquet(f"{path}/vocab").orderBy("label_idx").collect()
        return cls(w, b, [r.label for r in vocab], json.loads(meta.preprocess))


def score(df: DataFrame, model: PackagedModel, features_col: str = "features",
          out: str = "prediction", output: str = "label", batch_size: int = 128,
          limit: int | None = None, order_by: list[str] | None = None) -> DataFrame:
    """Add the model's prediction.  ``limit`` (optionally after an order, for
    a reproducible subset) is applied before the UDF, as in the original
    demo; by default the whole table is scored."""
    if limit is not None:
        df = (df.orderBy(*order_by) if order_by else df).limit(limit)
    return df.withColumn(out, model.udf(output, batch_size)(F.col(features_col)))


def resolve(store, uri: str) -> str:
    """The run behind ``runs:/<run>``, ``models:/<name>/<stage>`` or
    ``models:/<name>/<version>`` of a ``RunStore``."""
    kind, _, rest = uri.partition(":/")
    if kind == "runs" and rest:
        return rest
    name, _, which = rest.rpartition("/")
    if kind != "models" or not name or not which:
        raise ValueError(f"{uri!r} is neither runs:/<run> nor models:/<name>/<stage or version>")
    if which.isdigit():
        row = (store.table("registrations").filter((F.col("name") == name) & (F.col("version") == int(which)))
               .select("run_id").first())
        run = row.run_id if row else None
    else:
        run = store.run_for_stage(name, which)
    if run is None:
        raise KeyError(f"no model at {uri!r}")
    return run


def register_function(spark: SparkSession, store, uri: str, name: str, output: str = "label", batch_size: int = 128) -> PackagedModel:
    """Make the model at ``uri`` a SQL function of a feature array:
    ``SELECT name(features) FROM t``.  It stays the version that the address
    meant when it was registered; register again after a promotion."""
    model = store.load_model(resolve(store, uri))
    udf = predict_batch_udf(model.make_shared_predict_fn(spark, output),
                            return_type=StringType() if output == "label" else IntegerType(),
                            batch_size=batch_size, input_tensor_shapes=[[model.num_features]])
    spark.udf.register(name, udf)
    return model
