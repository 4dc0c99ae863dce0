"""Exact positional indexes at scale.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task.  When the groups are few and large (a shard holds 1/n of the
data, a global vocabulary order holds all of it) that task is the whole job.
``row_index`` computes the same number with work spread over all partitions:

1. range-partition on (g, o) and sort inside each partition; number the rows
   with ``monotonically_increasing_id`` (partition index in the high bits,
   position in the low 33 bits) and write the result once under the shared
   checkpoint folder -- this cuts lineage, so a lost executor re-reads files
   instead of re-running the sort;
2. aggregate per (partition, g): first id and row count -- at most
   ``partitions + groups`` rows;
3. a running sum over that small table gives each (partition, g) the number
   of rows of g that live in earlier partitions;
4. join back (AQE chooses the join by bytes) and add.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowline.session import scratch_path

def default_partitions(spark) -> int:
    sp = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(sp, spark.sparkContext.defaultParallelism)


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def partitions_for(df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Partition count for an explicit (fixed-count) shuffle such as
    ``repartitionByRange(n)``, which AQE will not split: about
    ``target_bytes`` per partition by the optimizer's size estimate, never
    fewer than the session default."""
    base = default_partitions(df.sparkSession)

    def as_int(v):
        return v if isinstance(v, int) else int(v.toString())

    plan = df._jdf.queryExecution().optimizedPlan()
    # Join estimates can be wildly high (a 2,000-row join was estimated at
    # ~1 TB), so bound the estimate by what is actually read: the sum of the
    # leaves' sizes (scans, cached or checkpointed relations).  Leaves with no
    # statistics report Long.MaxValue and are ignored.
    leaves = plan.collectLeaves()
    sizes = [as_int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.length())]
    known = [k for k in sizes if k < (1 << 62)]
    if not known:
        return base
    size = min(as_int(plan.stats().sizeInBytes()), sum(known))
    return int(max(base, -(-size // target_bytes)))


def row_index(df: DataFrame, order_cols, group_cols=(), out: str = "row_idx",
              partitions: int | None = None, path: str | None = None,
              staged_paths: list | None = None) -> DataFrame:
    """0-based position of each row in its group, ordered by ``order_cols``.

    ``order_cols`` must give a total order inside each group (end with a
    unique id) so the result is deterministic."""
    spark = df.sparkSession
    order_cols = list(order_cols)
    group_cols = list(group_cols)
    p = partitions or partitions_for(df)
    keys = group_cols + order_cols
    staged = (df.repartitionByRange(p, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_rid", F.monotonically_increasing_id()))
    path = path or scratch_path(spark, "row_index")
    staged.write.mode("overwrite").parquet(path)
    if staged_paths is not None:
        staged_paths.append(path)
    snap = spark.read.parquet(path)

    stats = (snap.groupBy(F.shiftright("_rid", 33).alias("_part"), *group_cols)
                 .agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(*group_cols).orderBy("_part") \
                   .rowsBetween(Window.unboundedPreceding, -1) if group_cols else \
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    offs = offs.select(*[F.col(g).alias(f"_g_{g}") for g in group_cols],
                       "_part", "_first", "_off")

    cond = [F.shiftright(snap["_rid"], 33) == offs["_part"]]
    cond += [snap[g].eqNullSafe(offs[f"_g_{g}"]) for g in group_cols]
    cond = reduce(lambda a, b: a & b, cond)
    # AQE broadcasts the offsets if their bytes are few
    return (snap.join(offs, cond).withColumn(out, (F.col("_rid") - F.col("_first") + F.col("_off")).cast("bigint"))
                  .drop("_rid", "_part", "_first", "_off", *[f"_g_{g}" for g in group_cols]))
