from pyspark.sql import functions as F

from flowline.operators import feed


def test_shards_disjoint_complete_and_batches(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    b = feed.with_batches(df, "k", shards=3, batch_size=64)
    rows = b.collect()
    assert len(rows) == 1000 and len({r.k for r in rows}) == 1000
    per = {}
    for r in rows:
        per.setdefault(r.shard, []).append(r.pos)
    for s, pos in per.items():
        assert sorted(pos) == list(range(len(pos)))          # contiguous from 0
    sizes = b.groupBy("shard", "batch_id").count().collect()
    assert all(r["count"] <= 64 for r in sizes)
    steps = feed.steps_per_epoch(1000, 64, 3)
    assert steps == 5
    full = feed.full_batches_only(b, 1000, 64, 3)
    assert full.agg(F.max("batch_id")).first()[0] == steps - 1


def test_steps_never_zero():
    assert feed.steps_per_epoch(10, 256, 2) == 1


def test_shard_layout_independent(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r.k: r.shard for r in feed.with_shard(df.repartition(1), "k", 4).collect()}
    b = {r.k: r.shard for r in feed.with_shard(df.repartition(5), "k", 4).collect()}
    assert a == b
