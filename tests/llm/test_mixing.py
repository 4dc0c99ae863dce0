import random

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from flowline.llm import mixing as M


def targets(sizes, weights=(5, 2, 1), percent=150, cap=2):
    """Water-filling by repetition: source -> target."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = sum(sizes.values()) * percent / 100, set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = [s for s in open_ if left * w[s] / total > cap * sizes[s]]
        if not full:
            out.update({s: left * w[s] / total for s in open_})
            break
        for s in full:
            out[s] = float(cap * sizes[s])
        left -= sum(out[s] for s in full)
        open_ -= set(full)
    return out


def test_contract_on_awkward_documents(docs):
    rows = M.mix(docs).collect()
    assert len(rows) == docs.count()
    want = {}
    for r in docs.select("source", "text").collect():
        want[r.source] = want.get(r.source, 0) + len((r.text or "").encode().split())
    goal = targets(want)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    taken: dict = {}
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == want[s] and abs(r.target - goal[s]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - goal[s]) <= M.BLOCK_WORDS + 1, s


def test_reruns_agree(small):
    a = {tuple(r) for r in M.mix(small).collect()}
    assert a == {tuple(r) for r in M.mix(small.repartition(7)).collect()}


def test_equals_sql(small):
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pandas(small.toPandas()))
    want = sorted(con.execute(M.oracle_sql()).fetchall())
    got = sorted(tuple(r) for r in M.mix(small).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == want


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 10, 97, 4096, 5000):
        got = [r[0] for r in spark.range(n).select(
            F.expr("id AS x"), "id", M.turns(f"CAST({n} AS BIGINT)", "CAST(99 AS BIGINT)").alias("turns"))
               .select("x", M.permute("id", f"CAST({n} AS BIGINT)", "turns").alias("p"))
               .orderBy("x").select("p").collect()]
        assert sorted(got) == list(range(n))
        if n > 90:
            assert sum(k == v for k, v in enumerate(got)) < n / 10


def test_shards_draw_by_target(small):
    t = M.source_targets(M.sized(small))
    s = M.slots(t).collect()
    assert sorted(r.position for r in s) == list(range(len(s)))
    assert len({(r.src, r["pass"], r.block) for r in s}) == len(s)
    goal = {r.src: r.target for r in t.collect()}
    share = {k: v / sum(goal.values()) for k, v in goal.items()}
    first = [r.src for r in s if r.shard == 0]
    for k, p in share.items():
        assert abs(first.count(k) / len(first) - p) < 6 * (p * (1 - p) / len(first)) ** 0.5 + 0.01


def test_mixed_documents(small):
    out = M.mixed_documents(small)
    assert out.columns == small.columns
    text = {r.doc_id: r.text for r in small.collect()}
    taken = {r.doc_id: r.taken for r in M.mix(small).collect()}
    got: dict = {}
    for r in out.collect():
        n = len(r.text.encode().split())
        assert r.n_chars == len(r.text) and n > 0
        got[r.doc_id] = got.get(r.doc_id, 0) + n
        pool = text[r.doc_id].encode().split()
        assert r.text == text[r.doc_id] or set(r.text.encode().split()) <= set(pool)
    assert got == {k: v for k, v in taken.items() if v}


def test_empty_table(spark, no_docs):
    assert M.mix(no_docs).count() == 0 and M.mixed_documents(no_docs).count() == 0
    rng = random.Random(1)
    blank = spark.createDataFrame([(k, rng.choice(["", None, " "]), "s") for k in range(5)],
                                  "doc_id long, text string, source string")
    assert {(r.size, r.taken, r.target) for r in M.mix(blank).collect()} == {(0, 0, 0.0)}


def test_blocks_are_the_draw(docs):
    out = M.mixed_blocks(docs, shard_slots=16)
    rows = out.withColumn("part", F.spark_partition_id()).collect()
    t = M.source_targets(M.sized(docs))
    drawn = M.slots(t, shard_slots=16).join(t.select("src", "source"), "src").collect()
    source = {r.position: (r.shard, r.source) for r in drawn}
    assert {r.position: (r.shard, r.source) for r in rows} == source and len(rows) == len(source) > 160
    at = [(r.part, r.shard, r.position) for r in rows]
    assert at == sorted(at) and len({r.part for r in rows}) > 1
    assert len({(r.part, r.shard) for r in rows}) == len({r.shard for r in rows})       # whole shards
    text = {r.doc_id: (r.text or "").encode().split() for r in docs.collect()}
    taken: dict = {}
    for r in rows:
        want = [w for p in r.pieces for w in text[p.doc_id][p.begin:p.begin + p.words]]
        assert r.text.encode() == b" ".join(want) and r.words == len(want) <= M.BLOCK_WORDS
        for p in r.pieces:
            taken[p.doc_id] = taken.get(p.doc_id, 0) + p.words
    want = {}
    for r in M.mix(docs).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert taken == {k: v for k, v in want.items() if v}


def test_documents_follow_the_draw(small):
    last: dict = {}
    for r in M.mixed_blocks(small, block_words=512, shard_slots=16).collect():
        for p in r.pieces:
            last.setdefault(p.doc_id, set()).add((r.shard, r.position))
    rows = M.mixed_documents(small, block_words=512, shard_slots=16).withColumn("part", F.spark_partition_id()).collect()
    shards: dict = {}
    for r in rows:
        shards.setdefault(r.part, []).append(r)
    assert len(shards) > 1
    # one document of one block of one pass has one place: these come in the order of shard and position
    places = [next(iter(last[r.doc_id])) for r in rows if len(last[r.doc_id]) == 1]
    assert len(places) > 10 and places == sorted(places)
    assert [r.source for r in rows] != sorted([r.source for r in rows])


def test_rows_of_one_doc_id_are_spread(spark):
    """A third of the rows hold one doc_id: no bucket gets more than a few."""
    df = spark.range(6_000).selectExpr("IF(id % 3 = 0, 7L, id) AS doc_id", "concat('t ', id) AS text", "'s' AS source")
    sizes = M.sized(df).groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert sizes <= 12
    rows = M.mix(df).collect()
    assert len(rows) == 6_000 and abs(sum(r.taken for r in rows) - 18_000) <= 2 * M.BLOCK_WORDS


def test_partitions_follow_the_slots(spark):
    t = M.source_targets(spark.range(3).selectExpr("concat('s', id) AS source", "(id + 1) * 1000000 AS size"))
    n = M.slots(t).count()
    assert M._parts(t, M.CAP, M.BLOCK_WORDS, 1_000) == -(-n // 1_000) > 100
    assert M._parts(t, M.CAP, M.BLOCK_WORDS, 10 ** 9) == M.default_partitions(spark)
    assert M._parts(t.limit(0), M.CAP, M.BLOCK_WORDS, 10) == M.default_partitions(spark)
