"""Training-data feed: shards, mini-batches, steps per epoch.

A shard is a hash of a stable row key modulo the worker count, so shards are
disjoint, complete and balanced whatever the input layout.  The position of a
row inside its shard (hence its mini-batch) follows a hash order and is
computed by ``row_index`` -- a shard holds 1/n of the data, so it must never
be numbered inside one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowline.functions.columns import hash_bucket, hash_u32
from flowline.operators.ranking import row_index


def repartition_for_workers(df: DataFrame, workers: int) -> DataFrame:
    """Exactly ``workers`` balanced partitions (round-robin shuffle), as the
    original workflow does before handing data to its workers."""
    return df.repartition(int(workers))


def with_shard(df: DataFrame, key: str, shards: int, salt: str = "shard",
               out: str = "shard") -> DataFrame:
    return df.withColumn(out, hash_bucket(key, shards, salt).cast("int"))


def with_positions(df: DataFrame, key: str, shards: int, salt: str = "shard", order_salt: str = "order",
                   partitions: int | None = None, staged_paths: list | None = None) -> DataFrame:
    """Adds ``shard`` and ``pos`` (0-based position in the shard, hash order).
    The folder ``row_index`` writes is appended to ``staged_paths`` (for the
    caller to delete later)."""
    s = with_shard(df, key, shards, salt).withColumn("_h", hash_u32(key, order_salt))
    return row_index(s, ["_h", key], ["shard"], out="pos", partitions=partitions,
                     staged_paths=staged_paths).drop("_h")


def with_batches(df: DataFrame, key: str, shards: int, batch_size: int,
                 salt: str = "shard", order_salt: str = "order",
                 partitions: int | None = None, staged_paths: list | None = None) -> DataFrame:
    """Adds ``shard``, ``pos`` (0-based position in the shard, hash order) and
    ``batch_id = pos // batch_size``.  The folder ``row_index`` writes is
    appended to ``staged_paths`` (for the caller to delete later)."""
    idx = with_positions(df, key, shards, salt, order_salt, partitions, staged_paths)
    return idx.withColumn("batch_id", F.floor(F.col("pos") / F.lit(batch_size)).cast("bigint"))


def steps_per_epoch(n_rows: int, batch_size: int, workers: int = 1) -> int:
    """Full batches per worker per epoch, never below one."""
    return max(1, int(n_rows) // (int(batch_size) * int(workers)))


def full_batches_only(batched: DataFrame, n_rows: int, batch_size: int, workers: int) -> DataFrame:
    """The batches of one epoch alone, without what is left over (the trainer
    doesn't cut: its feed goes on through the leftover in the next epoch)."""
    return batched.filter(F.col("batch_id") < F.lit(steps_per_epoch(n_rows, batch_size, workers)))


def visits(pos: Column, shard_rows: Column, first: int | Column, last: int | Column) -> Column:
    """How often a row at ``pos`` of a shard of ``shard_rows`` rows is read
    while the shard's endless feed (its rows in order, again and again) goes
    from row ``first`` up to, not including, row ``last``."""
    first, last = (F.lit(x) if isinstance(x, int) else x for x in (first, last))

    def before(n):      # rows of the endless feed below n that are this one
        return F.floor((n - pos + shard_rows - 1) / shard_rows)

    return (before(last) - before(first)).cast("bigint")


def feed_visits(positioned: DataFrame, batch_size: int, workers: int, epochs: int) -> DataFrame:
    """``positioned`` (with_positions) with ``visits``: how often each row is
    read in ``epochs`` epochs of ``steps_per_epoch`` steps, where step t of the
    whole fit reads rows t*B .. (t+1)*B of each shard's endless feed."""
    sizes = positioned.groupBy("shard").agg(F.count(F.lit(1)).alias("shard_rows"))
    total = positioned.agg(F.count(F.lit(1)).alias("n_rows"))
    steps = F.greatest(F.lit(1), F.floor(total.select("n_rows").scalar() / (batch_size * workers)))
    return (positioned.join(sizes, "shard")
            .withColumn("visits", visits(F.col("pos"), F.col("shard_rows"), 0, steps * (epochs * batch_size))))
