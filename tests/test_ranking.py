import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowline.operators.ranking import row_index


def test_row_index_matches_window_with_skew(spark):
    rnd = random.Random(7)
    # one hot group holds most rows
    rows = [(i, "hot" if rnd.random() < 0.6 else rnd.choice("abcde"), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    expect = {r.id: r.i for r in df.select(
        "id", (F.row_number().over(Window.partitionBy("g").orderBy("v", "id")) - 1).alias("i")).collect()}
    for p in (1, 3, 7):
        got = {r.id: r.row_idx for r in row_index(df, ["v", "id"], ["g"], partitions=p).collect()}
        assert got == expect


def test_row_index_global_and_desc(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(100)], "id long, v double")
    got = row_index(df, [F.col("v").desc(), F.col("id").asc()], partitions=4)
    expect = {r.id: r.i for r in df.select(
        "id", (F.row_number().over(Window.orderBy(F.col("v").desc(), "id")) - 1).alias("i")).collect()}
    assert {r.id: r.row_idx for r in got.collect()} == expect


def test_hot_group_is_spread_over_tasks(spark):
    # 90% of rows in one group: the staged (range-partitioned) files must
    # spread that group instead of giving it to one task
    rows = [(i, "hot" if i % 10 else "cold") for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, g string")
    staged = []
    row_index(df, ["id"], ["g"], partitions=8, staged_paths=staged)
    per_file = (spark.read.parquet(staged[0]).groupBy(F.input_file_name()).count()
                .select("count").collect())
    assert max(r[0] for r in per_file) < 0.3 * 4000


def test_partitions_grow_with_input_but_not_with_join_estimates(spark):
    from flowline.operators.ranking import default_partitions, partitions_for
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    base = default_partitions(spark)
    assert partitions_for(li) == base                        # small input: the default
    many = partitions_for(li, target_bytes=64 * 1024)
    assert many > base                                        # grows with the bytes read
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    joined = li.join(o, li.l_orderkey == o.o_orderkey)
    # the join's own estimate can be far larger than its inputs; the count is
    # bounded by what is read
    assert partitions_for(joined, target_bytes=64 * 1024) <= many + partitions_for(o, 64 * 1024)
