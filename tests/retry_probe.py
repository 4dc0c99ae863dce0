"""Run in a separate process (its own SparkContext with task retries):
first attempts of some tasks fail; results must equal a failure-free run."""
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def flaky(df):
    """Identity that fails the first attempt of every even partition."""
    schema = df.schema

    def run(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    return df.mapInPandas(run, schema)


def main():
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from flowline.session import ensure_checkpoint_dir, ship_package
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    from flowline.operators import trainer as TR
    from flowline.operators.ranking import row_index

    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"),
        F.col("label").alias("label_idx")).repartition(4)
    rng = np.random.default_rng(0)
    W = rng.normal(0, 0.1, size=(1, 65, 10))
    clean = TR.all_reduce(e, W, np.array([0.3]), 1, 0, 0, True)
    retried = TR.all_reduce(flaky(e), W, np.array([0.3]), 1, 0, 0, True)
    grads_equal = bool(np.allclose(clean[0], retried[0], atol=1e-12) and clean[3] == retried[3])

    g = e.select("row_id", (F.col("row_id") % 3).alias("g"))
    a = {r.row_id: r.row_idx for r in row_index(g, ["row_id"], ["g"], partitions=4).collect()}
    b = {r.row_id: r.row_idx for r in row_index(flaky(g), ["row_id"], ["g"], partitions=4).collect()}
    print(json.dumps({"grads_equal": grads_equal, "row_index_equal": a == b, "rows": len(a)}))
    spark.stop()


if __name__ == "__main__":
    main()
