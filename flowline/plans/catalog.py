"""Registered queries and their SQL oracles.

Each query takes (spark, sf_dir) and returns a DataFrame over the given
tables; ``ORACLE[name]`` is the same computation in plain SQL for DuckDB.
Floating results are rounded to 6 digits after aggregation in both.

Stand-ins: ``pages.url`` is a file path, ``encode(text)`` is file content,
``event_type``/``lang`` are labels, ``embeddings`` are pooled image features
with their class index.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowline.functions import columns as C
from flowline.operators import features as FE
from flowline.operators import feed, metrics, prepare
from flowline.operators import parzen as PZ
from flowline.operators import runs as R
from flowline.operators import search as S
from flowline.operators import trainer as TR
from flowline.operators import trials as TS
from flowline.operators.infer import PackagedModel, register_function, score
from flowline.sources import files as FS
from flowline.sources import tables as TB
from flowline.session import scratch_path

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def T(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def u_sql(expr: str, salt: str = "") -> str:
    """DuckDB twin of ``hash_unit``."""
    s = f"'{salt}' || CAST({expr} AS VARCHAR)" if salt else f"CAST({expr} AS VARCHAR)"
    return f"(CAST(CAST('0x' || substr(md5({s}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0)"


def u32_sql(expr: str, salt: str = "") -> str:
    s = f"'{salt}' || CAST({expr} AS VARCHAR)" if salt else f"CAST({expr} AS VARCHAR)"
    return f"CAST('0x' || substr(md5({s}), 1, 8) AS BIGINT)"


def _r6(c):
    """Round to 6 digits; ``+ 0.0`` turns a rounded -0.0 into 0.0 (the SQL
    oracles do the same), so signed zeros never differ between engines."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


# Fixed parameters of the registered queries (not tuned per data set).
SPLIT = (0.9, 0.1)
SHARDS = 4
BATCH = 256
NUM_CLASSES = 10
DIM = 64


# =========================================================== scans and sinks
@register("bronze_binary_rows", """
SELECT doc_id,
       'documents/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
       CAST(octet_length(encode(text)) AS BIGINT) AS length,
       md5(text) AS content_md5,
       string_split('documents/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt', '/')[-2] AS label
FROM documents""")
def q_bronze_binary_rows(spark, d):
    """Documents as bronze rows (path, length, content digest) + label from the path."""
    docs = T(spark, d, "documents")
    bronze = docs.select(
        "doc_id",
        F.concat(F.lit("documents/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.encode("text", "UTF-8").alias("content"))
    bronze = bronze.withColumn("length", F.octet_length("content").cast("bigint"))
    silver = prepare.with_label_from_path(bronze, "path")
    return silver.select("doc_id", "path", "length", F.md5("content").alias("content_md5"), "label")


@register("sql_select_all", "SELECT * FROM customer")
def q_sql_select_all(spark, d):
    """SQL scan over a registered view."""
    # a namespaced view name: never replaces a view the caller registered
    T(spark, d, "customer").createOrReplaceTempView("flowline_customer")
    return TB.sql_scan(spark, "flowline_customer")


@register("table_round_trip", "SELECT * FROM customer")
def q_table_round_trip(spark, d):
    """Overwrite sink with a per-write uncompressed codec, read back."""
    name = "flowline_customer_round_trip"
    TB.save_table(T(spark, d, "customer"), name, compression="uncompressed",
                  path=scratch_path(spark, "tables", name))
    return TB.read_table(spark, name)


@register("snapshot_count", "SELECT count(*) AS n_rows FROM embeddings")
def q_snapshot_count(spark, d):
    """Snapshot written under the checkpoint folder; its length."""
    snap = TB.Snapshot(T(spark, d, "embeddings"), cache=False)
    return snap.df.agg(F.count(F.lit(1)).alias("n_rows"))


# =========================================================== labels, samples, splits
_LABEL_SQL = "SELECT page_id, url, string_split(url, '/')[-2] AS label FROM pages"


@register("label_from_path", _LABEL_SQL)
def q_label_from_path(spark, d):
    """label = parent directory (built-in split, no UDF)."""
    return prepare.with_label_from_path(T(spark, d, "pages").select("page_id", "url"), "url")


@register("label_from_path_pandas", _LABEL_SQL)
def q_label_from_path_pandas(spark, d):
    """The same label through a scalar pandas UDF (parity)."""
    @F.pandas_udf("string")
    def parent_dir(paths: pd.Series) -> pd.Series:
        return paths.str.rsplit("/", n=2).str.get(-2)

    return T(spark, d, "pages").select("page_id", "url", parent_dir("url").alias("label"))


@register("hash_sample_half", f"""
SELECT doc_id, lang FROM documents WHERE {u_sql('doc_id', 'sample')} < 0.5""")
def q_hash_sample_half(spark, d):
    """P5: reproducible 50% sample by an md5 hash of the id."""
    return prepare.hash_sample(T(spark, d, "documents"), "doc_id", 0.5).select("doc_id", "lang")


_SPLIT_SQL = f"CASE WHEN {u_sql('vec_id', 'split')} < 0.9 THEN 'train' ELSE 'val' END"


@register("hash_split_sizes", f"""
SELECT {_SPLIT_SQL} AS split, count(*) AS n_rows FROM embeddings GROUP BY 1""")
def q_hash_split_sizes(spark, d):
    """90/10 hash split, rows per split."""
    e = T(spark, d, "embeddings").withColumn("split", prepare.split_column("vec_id", SPLIT))
    return e.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("hash_split_rows", f"SELECT vec_id, {_SPLIT_SQL} AS split FROM embeddings")
def q_hash_split_rows(spark, d):
    """The split of every row."""
    return T(spark, d, "embeddings").select("vec_id", prepare.split_column("vec_id", SPLIT).alias("split"))


@register("split_is_partition", f"""
WITH parts AS (
  SELECT vec_id FROM embeddings WHERE {u_sql('vec_id', 'split')} < 0.9
  UNION ALL
  SELECT vec_id FROM embeddings WHERE NOT ({u_sql('vec_id', 'split')} < 0.9)),
seen AS (SELECT vec_id, count(*) AS t FROM parts GROUP BY vec_id),
j AS (SELECT e.vec_id AS wk, s.t FROM (SELECT vec_id FROM embeddings) e
      FULL OUTER JOIN seen s ON e.vec_id = s.vec_id)
SELECT CAST(sum(CASE WHEN t IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_rows,
       CAST(sum(CASE WHEN t > 1 THEN t - 1 ELSE 0 END) AS BIGINT) AS duplicate_rows,
       CAST(sum(CASE WHEN wk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS extra_rows
FROM j""")
def q_split_is_partition(spark, d):
    """The split parts cover the input exactly once."""
    e = T(spark, d, "embeddings")
    return prepare.split_partition_check(e, prepare.hash_split(e, "vec_id", SPLIT), "vec_id")


@register("distinct_labels", "SELECT DISTINCT event_type AS label FROM events WHERE event_type IS NOT NULL")
def q_distinct_labels(spark, d):
    """A2/O1: distinct labels, sorted."""
    ev = T(spark, d, "events").withColumnRenamed("event_type", "label")
    return prepare.distinct_labels(ev, "label").orderBy("label")


@register("num_classes", "SELECT count(DISTINCT label) AS num_classes FROM embeddings")
def q_num_classes(spark, d):
    """A3: number of distinct classes."""
    return prepare.num_classes(T(spark, d, "embeddings"), "label")


_VOCAB_DOCS = """SELECT lang AS label, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_idx
FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)"""


@register("label_vocab", _VOCAB_DOCS)
def q_label_vocab(spark, d):
    """Dense index over the sorted distinct labels."""
    return prepare.build_vocab(T(spark, d, "documents").withColumnRenamed("lang", "label"))


def _events_labelled(spark, d):
    return T(spark, d, "events").select("event_id", F.col("event_type").alias("label"))


_VOCAB_EVENTS = """vocab AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_idx
  FROM (SELECT DISTINCT event_type AS label FROM events WHERE event_type IS NOT NULL {cond}))"""


@register("label_index_join", f"""
WITH {_VOCAB_EVENTS.format(cond='')}
SELECT e.event_id, e.event_type AS label, v.label_idx
FROM events e LEFT JOIN vocab v ON e.event_type = v.label""")
def q_label_index_join(spark, d):
    """Label -> index by a size-checked broadcast join."""
    ev = _events_labelled(spark, d)
    return prepare.index_labels(ev, prepare.build_vocab(ev), handle_unseen="error")


@register("label_index_pandas", ORACLE["label_index_join"])
def q_label_index_pandas(spark, d):
    """The same index through a pandas UDF, the vocabulary (one number a
    class) as a broadcast variable: an executor gets it once."""
    ev = _events_labelled(spark, d)
    shared = spark.sparkContext.broadcast({r.label: r.label_idx for r in prepare.build_vocab(ev).collect()})   # K rows

    @F.pandas_udf("int")
    def to_idx(labels: pd.Series) -> pd.Series:
        return labels.map(shared.value).astype("Int32")

    return ev.withColumn("label_idx", to_idx("label"))


def _vocab_without_view(spark, d):
    ev = _events_labelled(spark, d)
    return ev, prepare.build_vocab(ev.filter(F.col("label") != "view"))


@register("unseen_skip", f"""
WITH {_VOCAB_EVENTS.format(cond="AND event_type <> 'view'")}
SELECT e.event_id, e.event_type AS label, v.label_idx
FROM events e JOIN vocab v ON e.event_type = v.label""")
def q_unseen_skip(spark, d):
    """Labels missing from the vocabulary are skipped."""
    ev, vocab = _vocab_without_view(spark, d)
    return prepare.index_labels(ev, vocab, handle_unseen="skip")


@register("unseen_keep", f"""
WITH {_VOCAB_EVENTS.format(cond="AND event_type <> 'view'")}
SELECT e.event_id, e.event_type AS label,
       CAST(coalesce(v.label_idx, (SELECT count(*) FROM vocab)) AS INTEGER) AS label_idx
FROM events e LEFT JOIN vocab v ON e.event_type = v.label""")
def q_unseen_keep(spark, d):
    """Labels missing from the vocabulary get index = vocabulary size."""
    ev, vocab = _vocab_without_view(spark, d)
    return prepare.index_labels(ev, vocab, handle_unseen="keep")


@register("unseen_report", f"""
WITH {_VOCAB_EVENTS.format(cond="AND event_type <> 'view'")}
SELECT e.event_id, e.event_type AS label
FROM events e ANTI JOIN vocab v ON e.event_type = v.label""")
def q_unseen_report(spark, d):
    """Rows whose label has no vocabulary entry (anti join)."""
    ev, vocab = _vocab_without_view(spark, d)
    return prepare.unseen_labels(ev, vocab)


@register("index_to_label", f"""
WITH {_VOCAB_EVENTS.format(cond='')}
SELECT e.event_id, v.label_idx, v2.label
FROM events e JOIN vocab v ON e.event_type = v.label
LEFT JOIN vocab v2 ON v.label_idx = v2.label_idx""")
def q_index_to_label(spark, d):
    """Index -> label through the vocabulary."""
    ev = _events_labelled(spark, d)
    vocab = prepare.build_vocab(ev)
    idx = prepare.index_labels(ev, vocab).select("event_id", "label_idx")
    return prepare.index_to_label(idx, vocab)


@register("training_projection", """
SELECT vec_id, label AS label_idx, CAST(len(embedding) AS INTEGER) AS n_features,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) + 0.0 AS feature_sum
FROM embeddings""")
def q_training_projection(spark, d):
    """The (key, label index, features) projection fed to training."""
    e = T(spark, d, "embeddings").select("vec_id", F.col("label").alias("label_idx"), "embedding")
    return e.select("vec_id", "label_idx", F.size("embedding").alias("n_features"),
                    _r6(C.array_sum("embedding")).alias("feature_sum"))


# =========================================================== feed: shards, batches, steps
_SHARD_SQL = f"CAST({u32_sql('o_orderkey', 'shard')} % {SHARDS} AS INTEGER)"


@register("shard_sizes", f"SELECT {_SHARD_SQL} AS shard, count(*) AS n_rows FROM orders GROUP BY 1")
def q_shard_sizes(spark, d):
    """Rows per hash shard."""
    o = feed.with_shard(T(spark, d, "orders"), "o_orderkey", SHARDS)
    return o.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"))


_BATCH_SQL = f"""batched AS (
  SELECT o_orderkey, shard,
         CAST((row_number() OVER (PARTITION BY shard ORDER BY h, o_orderkey) - 1) // {BATCH} AS BIGINT) AS batch_id
  FROM (SELECT o_orderkey, {_SHARD_SQL} AS shard, {u32_sql('o_orderkey', 'order')} AS h FROM orders))"""


def _batched_orders(spark, d):
    return feed.with_batches(T(spark, d, "orders").select("o_orderkey"), "o_orderkey", SHARDS, BATCH)


@register("minibatches", f"WITH {_BATCH_SQL} SELECT o_orderkey, shard, batch_id FROM batched")
def q_minibatches(spark, d):
    """Mini-batch number inside each shard (distributed row_index)."""
    return _batched_orders(spark, d).select("o_orderkey", "shard", "batch_id")


_STEPS_ORDERS = f"(SELECT greatest(1, count(*) // ({BATCH} * {SHARDS})) FROM orders)"


@register("full_batches_only", f"""
WITH {_BATCH_SQL}
SELECT shard, batch_id, count(*) AS n_rows FROM batched
WHERE batch_id < {_STEPS_ORDERS} GROUP BY 1, 2""")
def q_full_batches_only(spark, d):
    """Only the batches every shard can fill in an epoch."""
    b = _batched_orders(spark, d)
    n = T(spark, d, "orders").count()
    return (feed.full_batches_only(b, n, BATCH, SHARDS)
            .groupBy("shard", "batch_id").agg(F.count(F.lit(1)).alias("n_rows")))


@register("rows_per_step", f"""
WITH {_BATCH_SQL}
SELECT batch_id AS step, count(*) AS n_rows FROM batched
WHERE batch_id < {_STEPS_ORDERS} GROUP BY 1""")
def q_rows_per_step(spark, d):
    """Rows per synchronous step across shards."""
    b = _batched_orders(spark, d)
    n = T(spark, d, "orders").count()
    return (feed.full_batches_only(b, n, BATCH, SHARDS)
            .groupBy(F.col("batch_id").alias("step")).agg(F.count(F.lit(1)).alias("n_rows")))


@register("feed_visits", f"""
WITH keyed AS (SELECT o_orderkey, {_SHARD_SQL} AS shard, {u32_sql('o_orderkey', 'order')} AS h FROM orders),
sized AS (SELECT o_orderkey, row_number() OVER (PARTITION BY shard ORDER BY h, o_orderkey) - 1 AS pos,
                 count(*) OVER (PARTITION BY shard) AS m FROM keyed),
last AS (SELECT 3 * {BATCH} * {_STEPS_ORDERS} AS n)
SELECT o_orderkey, CAST((n - pos + m - 1) // m - (m - 1 - pos) // m AS BIGINT) AS visits FROM sized, last""")
def q_feed_visits(spark, d):
    """How often the trainer reads each row in three epochs; the feed
    goes on through the leftover of an epoch in the next one."""
    o = T(spark, d, "orders").select("o_orderkey")
    return (feed.feed_visits(feed.with_positions(o, "o_orderkey", SHARDS), BATCH, SHARDS, 3)
            .select("o_orderkey", "visits"))


@register("steps_per_epoch", f"""
SELECT count(*) FILTER (WHERE {_SPLIT_SQL} = 'train') AS n_train,
       count(*) FILTER (WHERE {_SPLIT_SQL} = 'val') AS n_val,
       CAST(greatest(1, floor(count(*) FILTER (WHERE {_SPLIT_SQL} = 'train') / (32 * 2))) AS BIGINT) AS steps_per_epoch,
       CAST(greatest(1, floor(count(*) FILTER (WHERE {_SPLIT_SQL} = 'val') / (32 * 2))) AS BIGINT) AS validation_steps
FROM embeddings""")
def q_steps_per_epoch(spark, d):
    """rows // (batch x workers), never below 1."""
    e = T(spark, d, "embeddings").withColumn("split", prepare.split_column("vec_id", SPLIT))
    counts = e.agg(F.count(F.when(F.col("split") == "train", 1)).alias("n_train"),
                   F.count(F.when(F.col("split") == "val", 1)).alias("n_val"))
    return counts.select("n_train", "n_val",
                         C.steps_per_epoch("n_train", F.lit(32), F.lit(2)).cast("bigint").alias("steps_per_epoch"),
                         C.steps_per_epoch("n_val", F.lit(32), F.lit(2)).cast("bigint").alias("validation_steps"))


# =========================================================== arrays, pooling, head
@register("pixel_scale", """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / 127.5 - 1)), 6) + 0.0 AS scaled_sum
FROM embeddings""")
def q_pixel_scale(spark, d):
    """x / 127.5 - 1 over arrays."""
    e = T(spark, d, "embeddings")
    return e.select("vec_id", _r6(C.array_sum(C.pixel_scale("embedding"))).alias("scaled_sum"))


@register("float_cast", """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(CAST(CAST(x AS DOUBLE) * 3 AS FLOAT) AS DOUBLE))), 6) + 0.0 AS float_sum
FROM embeddings""")
def q_float_cast(spark, d):
    """cast to float32 arrays."""
    e = T(spark, d, "embeddings")
    tripled = F.transform("embedding", lambda x: x.cast("double") * F.lit(3.0))
    return e.select("vec_id", _r6(C.array_sum(C.to_float_array(tripled))).alias("float_sum"))


def global_avg_pool(arr, channels: int):
    """Mean per channel of an interleaved (H*W*C) pixel array, per row: no
    explode, no shuffle."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(channels - 1)),
        lambda c: F.aggregate(F.filter(arr, lambda x, i: (i % channels) == c),
                              F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double"))
        / (F.size(arr) / channels))


@register("global_avg_pool", """
SELECT vec_id, CAST((i - 1) % 4 AS INTEGER) AS channel, round(avg(CAST(x AS DOUBLE)), 6) + 0.0 AS pooled
FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
GROUP BY 1, 2""")
def q_global_avg_pool(spark, d):
    """Per-channel mean of interleaved pixel arrays (per row, no explode)."""
    e = T(spark, d, "embeddings")
    pooled = e.select("vec_id", F.posexplode(global_avg_pool(F.col("embedding"), 4)).alias("channel", "pooled"))
    return pooled.select("vec_id", "channel", _r6("pooled").alias("pooled"))


_LOGITS_SQL = f"""logits AS (
  SELECT vec_id, label, k, sum(CAST(x AS DOUBLE) * sin(k * {DIM} + (i - 1))) AS logit
  FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
  CROSS JOIN range(0, {NUM_CLASSES}) r(k)
  GROUP BY vec_id, label, k)"""


def _sine_scored(spark, d):
    return T(spark, d, "embeddings").withColumn("logits", metrics.sine_logits("embedding", DIM, NUM_CLASSES))


@register("dense_logits", f"""
WITH {_LOGITS_SQL}
SELECT vec_id, CAST(k AS INTEGER) AS k, round(logit, 6) + 0.0 AS logit FROM logits""")
def q_dense_logits(spark, d):
    """M2: dense head logits with a fixed closed-form head."""
    s = _sine_scored(spark, d)
    return s.select("vec_id", F.posexplode("logits").alias("k", "logit")) \
            .select("vec_id", "k", _r6("logit").alias("logit"))


@register("softmax_probs", f"""
WITH {_LOGITS_SQL},
m AS (SELECT vec_id, max(logit) AS mx FROM logits GROUP BY 1),
e AS (SELECT l.vec_id, l.k, exp(l.logit - m.mx) AS ex FROM logits l JOIN m USING (vec_id))
SELECT vec_id, CAST(k AS INTEGER) AS k, round(ex / sum(ex) OVER (PARTITION BY vec_id), 6) AS prob FROM e""")
def q_softmax_probs(spark, d):
    """F16: class probabilities."""
    s = _sine_scored(spark, d)
    return s.select("vec_id", F.posexplode(C.softmax("logits")).alias("k", "prob")) \
            .select("vec_id", "k", F.round("prob", 6).alias("prob"))


@register("argmax_class", f"""
WITH {_LOGITS_SQL}
SELECT vec_id, CAST(arg_max(k, logit) AS INTEGER) AS pred_idx FROM logits GROUP BY 1""")
def q_argmax_class(spark, d):
    """First-maximum class index."""
    return _sine_scored(spark, d).select("vec_id", C.array_argmax("logits").alias("pred_idx"))


_CE_SQL = f"""{_LOGITS_SQL},
per_row AS (
  SELECT vec_id, any_value(label) AS label,
         max(logit) + ln(sum(exp(logit - mx))) - max(CASE WHEN k = label THEN logit END) AS ce,
         CASE WHEN arg_max(k, logit) = any_value(label) THEN 1.0 ELSE 0.0 END AS hit
  FROM (SELECT *, max(logit) OVER (PARTITION BY vec_id) AS mx FROM logits)
  GROUP BY vec_id)"""


@register("cross_entropy", f"""
WITH {_CE_SQL}
SELECT round(avg(ce), 6) AS loss, count(*) AS n_rows FROM per_row""")
def q_cross_entropy(spark, d):
    """A4: mean cross-entropy from logits."""
    s = _sine_scored(spark, d).withColumnRenamed("label", "label_idx")
    return metrics.loss_and_accuracy(s).select("loss", "n_rows")


@register("accuracy", f"""
WITH {_CE_SQL}
SELECT round(avg(hit), 6) AS accuracy, count(*) AS n_rows FROM per_row""")
def q_accuracy(spark, d):
    """A5: accuracy."""
    s = _sine_scored(spark, d).withColumnRenamed("label", "label_idx")
    return metrics.loss_and_accuracy(s).select("accuracy", "n_rows")


_SHARD2_SQL = f"CAST({u32_sql('vec_id', 'shard')} % 2 AS INTEGER)"


@register("metric_average_weighted", f"""
WITH {_CE_SQL},
s AS (SELECT {_SHARD2_SQL} AS shard, sum(ce) AS loss_sum, sum(hit) AS correct, count(*) AS n
      FROM per_row GROUP BY 1)
SELECT round(sum(loss_sum) / sum(n), 6) AS loss, round(sum(correct) / sum(n), 6) AS accuracy FROM s""")
def q_metric_average_weighted(spark, d):
    """Metric all-reduce weighted by shard rows."""
    s = feed.with_shard(_sine_scored(spark, d).withColumnRenamed("label", "label_idx"), "vec_id", 2)
    return metrics.metric_average(metrics.shard_metrics(s), weighted=True)


@register("metric_average_shards", f"""
WITH {_CE_SQL},
s AS (SELECT {_SHARD2_SQL} AS shard, sum(ce) AS loss_sum, sum(hit) AS correct, count(*) AS n
      FROM per_row GROUP BY 1)
SELECT round(avg(loss_sum / n), 6) AS loss, round(avg(correct / n), 6) AS accuracy FROM s""")
def q_metric_average_shards(spark, d):
    """Plain mean of per-shard metrics."""
    s = feed.with_shard(_sine_scored(spark, d).withColumnRenamed("label", "label_idx"), "vec_id", 2)
    return metrics.metric_average(metrics.shard_metrics(s), weighted=False)


@register("prefixed_metrics", f"""
WITH {_CE_SQL}
SELECT 'val_loss' AS metric, round(avg(ce), 6) AS value FROM per_row
UNION ALL
SELECT 'val_accuracy' AS metric, round(avg(hit), 6) AS value FROM per_row""")
def q_prefixed_metrics(spark, d):
    """metrics as a val_-prefixed map, one row per metric."""
    s = _sine_scored(spark, d).withColumnRenamed("label", "label_idx")
    return metrics.prefixed_metrics(metrics.loss_and_accuracy(s))


@register("final_evaluation", f"""
WITH {_CE_SQL},
v AS (SELECT * FROM per_row WHERE NOT ({u_sql('vec_id', 'split')} < 0.9))
SELECT 'val_loss' AS metric, round(avg(ce), 6) AS value FROM v
UNION ALL
SELECT 'val_accuracy' AS metric, round(avg(hit), 6) AS value FROM v""")
def q_final_evaluation(spark, d):
    """Final loss/accuracy on the validation split."""
    e = T(spark, d, "embeddings")
    _, val = prepare.hash_split(e, "vec_id", SPLIT)
    s = val.withColumn("logits", metrics.sine_logits("embedding", DIM, NUM_CLASSES)) \
           .withColumnRenamed("label", "label_idx")
    return metrics.prefixed_metrics(metrics.loss_and_accuracy(s))


# =========================================================== gradient all-reduce
_GRAD_SQL = f"""rows AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
n AS (SELECT count(*) AS n FROM embeddings),
grad AS (
  SELECT CAST(k AS INTEGER) AS k, CAST(pos AS INTEGER) AS pos,
         sum(CAST(x AS DOUBLE) * (1.0 / {NUM_CLASSES} - CASE WHEN label = k THEN 1.0 ELSE 0.0 END)) / (SELECT n FROM n) AS g
  FROM rows CROSS JOIN range(0, {NUM_CLASSES}) r(k) GROUP BY 1, 2
  UNION ALL
  SELECT CAST(k AS INTEGER) AS k, {DIM} AS pos,
         sum(1.0 / {NUM_CLASSES} - CASE WHEN label = k THEN 1.0 ELSE 0.0 END) / (SELECT n FROM n) AS g
  FROM embeddings CROSS JOIN range(0, {NUM_CLASSES}) r(k) GROUP BY 1)"""


def _emb_features(spark, d):
    return T(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"),
                                            F.col("embedding").alias("features"),
                                            F.col("label").alias("label_idx"))


@register("gradient_step0", f"WITH {_GRAD_SQL} SELECT k, pos, round(g, 6) + 0.0 AS grad FROM grad")
def q_gradient_step0(spark, d):
    """Mean gradient at zero weights through the distributed all-reduce."""
    W = np.zeros((1, DIM + 1, NUM_CLASSES))
    g = TR.gradient_frame(_emb_features(spark, d), W)
    return g.select("k", "pos", (F.round("grad", 6) + F.lit(0.0)).alias("grad"))


@register("sgd_step1", f"""
WITH {_GRAD_SQL},
w AS (SELECT k, pos, -0.5 * g AS w FROM grad),
lg AS (SELECT r.vec_id, any_value(r.label) AS label, w.k,
              sum(CAST(r.x AS DOUBLE) * w.w) + any_value(b.w) AS logit
       FROM rows r JOIN w ON r.pos = w.pos JOIN (SELECT k, w FROM w WHERE pos = {DIM}) b ON b.k = w.k
       GROUP BY r.vec_id, w.k),
pr AS (SELECT vec_id, any_value(label) AS label,
              max(logit) + ln(sum(exp(logit - mx))) - max(CASE WHEN k = label THEN logit END) AS ce,
              CASE WHEN arg_max(k, logit) = any_value(label) THEN 1.0 ELSE 0.0 END AS hit
       FROM (SELECT *, max(logit) OVER (PARTITION BY vec_id) AS mx FROM lg) GROUP BY vec_id)
SELECT round(avg(ce), 6) AS loss, round(avg(hit), 6) AS accuracy FROM pr""")
def q_sgd_step1(spark, d):
    """Loss and accuracy after one SGD step from zero."""
    data = _emb_features(spark, d)
    g, _, _ = TR.gradient(data, np.zeros((DIM, NUM_CLASSES)))
    w1 = -0.5 * g                         # one SGD step from zero, lr 0.5
    scored = data.withColumn("logits", metrics.dense_logits("features", w1[:DIM].T.tolist(), w1[DIM].tolist()))
    return metrics.loss_and_accuracy(scored).select("loss", "accuracy")


# =========================================================== schedules, names, json
_SPE_EMB = "(SELECT greatest(1, count(*) // 64) FROM embeddings)"


@register("lr_warmup", f"""
SELECT CAST(step AS INTEGER) AS step, round(step / {_SPE_EMB}, 6) AS epoch_frac,
       round(CASE WHEN step / {_SPE_EMB} < 5 THEN 0.002 / 2 * (1 + (step / {_SPE_EMB}) * (2 - 1) / 5.0)
                  ELSE 0.002 END, 9) AS lr
FROM range(0, 6 * {_SPE_EMB}) r(step)""")
def q_lr_warmup(spark, d):
    """warm-up schedule over every step of a 6-epoch fit."""
    # the step table grows with the data: generate it with a partitioned
    # range, not by exploding one row in one task
    spe = max(1, T(spark, d, "embeddings").count() // 64)
    steps = spark.range(0, 6 * spe).withColumnRenamed("id", "step")
    ef = F.col("step") / F.lit(spe)
    return steps.select(F.col("step").cast("int").alias("step"), F.round(ef, 6).alias("epoch_frac"),
                        F.round(C.warmup_lr(C.scaled_lr(F.lit(0.001), F.lit(2)), F.lit(2), ef, 5), 9).alias("lr"))


@register("lr_scaled", """
SELECT o_orderkey AS run_id, CAST(o_orderkey % 8 + 1 AS INTEGER) AS workers,
       round(CAST(0.001 AS DOUBLE) * CAST(o_orderkey % 8 + 1 AS INTEGER), 9) AS lr
FROM orders""")
def q_lr_scaled(spark, d):
    """Linear scaling rule per run: each run (order) trains on 1..8 workers;
    its learning rate is the base rate times its worker count."""
    o = T(spark, d, "orders")
    w = (F.col("o_orderkey") % 8 + 1).cast("int")
    return o.select(F.col("o_orderkey").alias("run_id"), w.alias("workers"),
                    F.round(C.scaled_lr(F.lit(0.001), w), 9).alias("lr"))


_ACCOUNT_SQL = "lower(replace(c_name, '#', '.')) || '@example.com'"
_IDENT_SQL = f"replace(split_part({_ACCOUNT_SQL}, '@', 1), '.', '_')"
_PARAM_SQL = "'batch_size_' || CAST(32 * (1 + c_custkey % 4) AS VARCHAR) || '_epochs_' || CAST(1 + c_nationkey % 3 AS VARCHAR)"


def _customer_names(spark, d):
    c = T(spark, d, "customer")
    acct = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    ident = C.safe_identifier(acct)
    params = C.param_string(batch_size=F.lit(32) * (F.col("c_custkey") % 4 + 1),
                            epochs=F.col("c_nationkey") % 3 + 1)
    return c.select("c_custkey", ident.alias("identifier"), params.alias("param_string"))


@register("identifier_from_user", f"SELECT c_custkey, {_IDENT_SQL} AS identifier FROM customer")
def q_identifier_from_user(spark, d):
    """account -> safe identifier."""
    return _customer_names(spark, d).select("c_custkey", "identifier")


@register("param_string", f"SELECT c_custkey, {_PARAM_SQL} AS param_string FROM customer")
def q_param_string(spark, d):
    """run name from integer parameters."""
    return _customer_names(spark, d).select("c_custkey", "param_string")


@register("checkpoint_path", f"""
SELECT c_custkey, '/checkpoints/' || {_IDENT_SQL} || '/' || {_PARAM_SQL} AS checkpoint_path FROM customer""")
def q_checkpoint_path(spark, d):
    """checkpoint path from identifier and parameters."""
    n = _customer_names(spark, d)
    return n.select("c_custkey", C.path_join(F.lit("/checkpoints"), "identifier", "param_string").alias("checkpoint_path"))


@register("json_config", """
SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k, 224 AS img_height, 224 AS img_width FROM events""")
def q_json_config(spark, d):
    """JSON config encode/decode round trip."""
    ev = T(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    cfg = F.to_json(F.struct(F.lit(224).alias("img_height"), F.lit(224).alias("img_width"), k.alias("k")))
    parsed = F.from_json(cfg, "img_height int, img_width int, k int")
    return ev.select("event_id", parsed.alias("c")).select("event_id", "c.k", "c.img_height", "c.img_width")


@register("head_by_id", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 10")
def q_head_by_id(spark, d):
    """Ordered head-10 preview (the limit is the feature)."""
    return TB.preview(T(spark, d, "events").select("event_id", "event_type", "value"), 10, ["event_id"])


@register("running_best_loss", """
WITH daily AS (
  SELECT CAST(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS INTEGER) AS epoch,
         round(avg(value), 6) + 0.0 AS val_loss
  FROM events GROUP BY 1)
SELECT epoch, val_loss, min(val_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_loss
FROM daily""")
def q_running_best_loss(spark, d):
    """Per-epoch loss and its running minimum."""
    ev = T(spark, d, "events").withColumn("day", F.to_date("ts"))
    first = ev.agg(F.min("day")).scalar()
    daily = ev.groupBy(F.datediff("day", first).cast("int").alias("epoch")) \
              .agg(_r6(F.avg("value")).alias("val_loss"))
    w = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("best_loss", F.min("val_loss").over(w))


# =========================================================== runs and registry
# runs: one per order (parent = the order whose key is the customer key);
# params from the order; per-epoch metrics from its line items.
_STATUS_STAGE = {"F": "Production", "O": "Staging", "P": "Archived"}


def _runs_tables(spark, d):
    o = T(spark, d, "orders")
    runs = o.select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("parent_run_id"),
                    F.col("o_orderstatus").alias("status"))
    params = o.select(F.col("o_orderkey").alias("run_id"),
                      F.explode(F.map_from_arrays(
                          F.array(F.lit("optimizer"), F.lit("batch_size")),
                          F.array(F.col("o_orderpriority"),
                                  (F.lit(32) * (F.col("o_orderkey") % 3 + 1)).cast("string")))).alias("key", "value"))
    li = T(spark, d, "lineitem")
    per_step = li.groupBy(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").cast("bigint").alias("step")) \
                 .agg(F.avg("l_discount").alias("val_loss"), F.avg("l_tax").alias("val_accuracy"))
    mets = per_step.select("run_id", "step", F.explode(F.map_from_arrays(
        F.array(F.lit("val_loss"), F.lit("val_accuracy")),
        F.array("val_loss", "val_accuracy"))).alias("key", "value"))
    return runs, params, mets


def _wide(spark, d):
    runs, params, mets = _runs_tables(spark, d)
    w = R.wide_runs(runs, params, mets, ["optimizer", "batch_size"], ["val_loss", "val_accuracy"])
    return w.withColumn("val_loss", F.round("val_loss", 6)).withColumn("val_accuracy", F.round("val_accuracy", 6))


_WIDE_SQL = """m AS (SELECT l_orderkey AS run_id, CAST(l_linenumber AS BIGINT) AS step,
                avg(l_discount) AS val_loss, avg(l_tax) AS val_accuracy
         FROM lineitem GROUP BY 1, 2),
last AS (SELECT run_id, arg_max(val_loss, step) AS val_loss, arg_max(val_accuracy, step) AS val_accuracy
         FROM m GROUP BY 1),
wide AS (SELECT o_orderkey AS run_id, o_custkey AS parent_run_id, o_orderstatus AS status,
                o_orderpriority AS optimizer, CAST(32 * (o_orderkey % 3 + 1) AS VARCHAR) AS batch_size,
                round(val_loss, 6) AS val_loss, round(val_accuracy, 6) AS val_accuracy
         FROM orders LEFT JOIN last ON last.run_id = o_orderkey)"""


@register("runs_wide", f"WITH {_WIDE_SQL} SELECT * FROM wide")
def q_runs_wide(spark, d):
    """One row per run with params and final metrics."""
    return _wide(spark, d).select("run_id", "parent_run_id", "status", "optimizer", "batch_size",
                                  "val_loss", "val_accuracy")


@register("search_runs", f"""
WITH {_WIDE_SQL}
SELECT parent_run_id, run_id, val_accuracy,
       row_number() OVER (PARTITION BY parent_run_id ORDER BY val_accuracy DESC NULLS LAST, run_id) AS rank
FROM wide""")
def q_search_runs(spark, d):
    """Runs ranked per parent by val_accuracy desc nulls last."""
    ranked = R.rank_runs(_wide(spark, d), "val_accuracy", "parent_run_id")
    return ranked.select("parent_run_id", "run_id", "val_accuracy", F.col("rank").cast("bigint").alias("rank"))


@register("runs_by_condition", f"""
WITH {_WIDE_SQL}
SELECT run_id, status, optimizer, batch_size, val_loss, val_accuracy,
       row_number() OVER (ORDER BY optimizer DESC NULLS LAST, val_loss ASC NULLS LAST, run_id) AS place
FROM wide WHERE (status = 'F' AND val_accuracy > 0.03 OR optimizer LIKE '%-URGENT') AND batch_size <> '64' AND val_loss <= 0.06
ORDER BY place LIMIT 100""")
def q_runs_by_condition(spark, d):
    """Runs by a condition of and, or, like and comparisons over
    attributes, parameters and metrics, in the order of two keys: the first
    hundred of all that meet it (a top report)."""
    runs, params, mets = _runs_tables(spark, d)
    found = R.select_runs(
        runs, params, mets, where="(attributes.status = 'F' AND round(metrics.val_accuracy, 6) > 0.03 OR params.optimizer LIKE '%-URGENT')"
                                  " AND params.batch_size <> '64' AND round(metrics.val_loss, 6) <= 0.06",
        order_by=["params.optimizer DESC", "round(metrics.val_loss, 6)"]).limit(100)
    w = Window.orderBy(F.desc_nulls_last("optimizer"), F.asc_nulls_last("val_loss"), "run_id")     # over the hundred
    return found.select("run_id", "status", F.col("`params.optimizer`").alias("optimizer"),
                        F.col("`params.batch_size`").alias("batch_size"), _r6("`metrics.val_loss`").alias("val_loss"),
                        _r6("`metrics.val_accuracy`").alias("val_accuracy")).withColumn(
        "place", F.row_number().over(w).cast("bigint"))


@register("top_run", f"""
WITH {_WIDE_SQL}
SELECT parent_run_id, run_id, val_accuracy FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_run_id ORDER BY val_accuracy DESC NULLS LAST, run_id) AS rn
  FROM wide) WHERE rn = 1""")
def q_top_run(spark, d):
    """O3: best run per parent (aggregate, not a sort)."""
    return R.top_runs(_wide(spark, d), "val_accuracy", "parent_run_id")


@register("search_runs_by_loss", f"""
WITH {_WIDE_SQL}
SELECT parent_run_id, run_id, val_loss,
       row_number() OVER (PARTITION BY parent_run_id ORDER BY val_loss ASC NULLS LAST, run_id) AS rank
FROM wide""")
def q_search_runs_by_loss(spark, d):
    """Runs ranked per parent by a loss, the smallest first."""
    ranked = R.rank_runs(_wide(spark, d), "val_loss", "parent_run_id")
    return ranked.select("parent_run_id", "run_id", "val_loss", F.col("rank").cast("bigint").alias("rank"))


@register("top_run_by_loss", f"""
WITH {_WIDE_SQL}
SELECT parent_run_id, run_id, val_loss FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_run_id ORDER BY val_loss ASC NULLS LAST, run_id) AS rn
  FROM wide) WHERE rn = 1""")
def q_top_run_by_loss(spark, d):
    """O3: best run per parent by a loss (aggregate, not a sort)."""
    return R.top_runs(_wide(spark, d), "val_loss", "parent_run_id")


@register("run_status", """
SELECT o_orderkey AS run_id, o_custkey AS parent_run_id,
       CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'F' THEN 'FINISHED' ELSE 'FAILED' END AS status
FROM orders""")
def q_run_status(spark, d):
    """G1: the status of every run from its rows: RUNNING at the start, one
    more row at the end unless it still runs."""
    o = T(spark, d, "orders")
    rows = o.select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("parent_run_id"),
                    F.lit("run").alias("name"), F.col("o_orderdate").alias("started_at"),
                    F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "P", "FAILED")
                    .alias("end"))
    events = (rows.withColumn("status", F.lit("RUNNING"))
              .unionByName(rows.filter("end IS NOT NULL").withColumn("status", F.col("end"))).drop("end"))
    return R.latest_status(events).select("run_id", "parent_run_id", "status")


@register("children_of_run", f"""
WITH {_WIDE_SQL} SELECT run_id, parent_run_id, val_accuracy FROM wide
WHERE parent_run_id = (SELECT min(o_custkey) FROM orders)""")
def q_children_of_run(spark, d):
    """The runs of one parent."""
    parent = T(spark, d, "orders").agg(F.min("o_custkey")).scalar()
    return R.filter_children(_wide(spark, d), parent).select("run_id", "parent_run_id", "val_accuracy")


@register("child_runs", """
SELECT c.o_orderkey AS run_id, c.o_custkey AS parent_run_id, p.o_orderstatus AS parent_status
FROM orders c JOIN orders p ON c.o_custkey = p.o_orderkey""")
def q_child_runs(spark, d):
    """Children joined to their parent run."""
    runs, _, _ = _runs_tables(spark, d)
    return R.child_runs(runs, cols=["status"]).select("run_id", "parent_run_id", "parent_status")


@register("final_metric", """
WITH m AS (SELECT l_orderkey AS run_id, CAST(l_linenumber AS BIGINT) AS step,
                  avg(l_discount) AS val_loss, avg(l_tax) AS val_accuracy
           FROM lineitem GROUP BY 1, 2),
u AS (SELECT run_id, step, 'val_loss' AS key, val_loss AS value FROM m
      UNION ALL SELECT run_id, step, 'val_accuracy' AS key, val_accuracy AS value FROM m)
SELECT run_id, key, round(arg_max(value, step), 6) AS value, max(step) AS last_step FROM u GROUP BY 1, 2""")
def q_final_metric(spark, d):
    """A10: last logged value of every metric of every run."""
    _, _, mets = _runs_tables(spark, d)
    f = metrics.final_metric(mets)
    return f.select("run_id", "key", F.round("value", 6).alias("value"), "last_step")


def _registrations(spark, d):
    return T(spark, d, "orders").select(F.col("o_orderpriority").alias("name"),
                                        F.col("o_orderkey").alias("run_id"),
                                        F.col("o_orderdate").alias("registered_at"),
                                        "o_orderstatus")


_VERSIONS_SQL = """versions AS (
  SELECT o_orderpriority AS name, o_orderkey AS run_id, o_orderstatus, o_orderdate,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS version
  FROM orders)"""


@register("model_versions", f"WITH {_VERSIONS_SQL} SELECT name, run_id, version FROM versions")
def q_model_versions(spark, d):
    """Version numbers per model name in registration order."""
    v = R.model_versions(_registrations(spark, d))
    return v.select("name", "run_id", F.col("version").cast("bigint").alias("version"))


def _stage_events(spark, d):
    v = R.model_versions(_registrations(spark, d))
    stage = F.when(F.col("o_orderstatus") == "F", "Production") \
             .when(F.col("o_orderstatus") == "O", "Staging").otherwise("Archived")
    e1 = v.select("name", "version", stage.alias("stage"), F.col("registered_at").alias("ts"),
                  F.lit(1).cast("bigint").alias("seq"))
    returned = (T(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
                .groupBy(F.col("l_orderkey").alias("run_id")).agg(F.max("l_shipdate").alias("ts")))
    e2 = v.join(returned, "run_id").select("name", "version", F.lit("Archived").alias("stage"), "ts",
                                           F.lit(2).cast("bigint").alias("seq"))
    return v, e1.unionByName(e2)


_STAGES_SQL = f"""{_VERSIONS_SQL},
ev AS (
  SELECT name, version, CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'Archived' END AS stage,
         o_orderdate AS ts, 1 AS seq
  FROM versions
  UNION ALL
  SELECT name, version, 'Archived' AS stage, r.ts, 2 AS seq
  FROM versions JOIN (SELECT l_orderkey, max(l_shipdate) AS ts FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r
    ON r.l_orderkey = versions.run_id),
cur AS (SELECT name, version, stage FROM (
  SELECT *, row_number() OVER (PARTITION BY name, version ORDER BY ts DESC, seq DESC) AS rn FROM ev) WHERE rn = 1)"""


@register("committed_versions", """
WITH best AS (SELECT o_orderpriority AS name, year(o_orderdate) AS y,
                     CAST(arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS VARCHAR) AS run_id FROM orders GROUP BY 1, 2)
SELECT name, run_id, CAST(row_number() OVER (PARTITION BY name ORDER BY y DESC) AS BIGINT) AS version FROM best""")
def q_committed_versions(spark, d):
    """Every priority's dearest order of each year, registered from the
    newest year to the oldest, each under its own (older) time: a version is
    the turn of its registration and stays so."""
    best = (T(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("name"), F.year("o_orderdate").alias("y"))
            .agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).cast("string").alias("run_id")))
    store = R.RunStore(spark, scratch_path(spark, "versions"))
    by_year: dict = {}
    for r in best.orderBy(F.desc("y"), "name").collect():     # one row a priority and year
        by_year.setdefault(r.y, []).append((r.name, r.run_id))
    for y, models in by_year.items():
        store.register_models(models, dt.datetime(y, 12, 31))
    return store.table("registrations").select("name", "run_id", "version")


@register("current_stage", f"WITH {_STAGES_SQL} SELECT name, version, stage FROM cur")
def q_current_stage(spark, d):
    """Latest stage of every model version (append-only events)."""
    _, ev = _stage_events(spark, d)
    cur = R.current_stages(ev)
    return cur.select("name", F.col("version").cast("bigint").alias("version"), "stage")


@register("production_model", f"""
WITH {_STAGES_SQL},
best AS (SELECT name, max(version) AS version FROM cur WHERE lower(stage) = 'production' GROUP BY 1)
SELECT b.name, b.version, v.run_id FROM best b JOIN versions v ON v.name = b.name AND v.version = b.version""")
def q_production_model(spark, d):
    """Highest version currently in Production, per name."""
    v, ev = _stage_events(spark, d)
    best = R.version_in_stage(R.current_stages(ev), "production")     # one row per name
    out = v.select("name", "version", "run_id").join(best, ["name", "version"])
    return out.select("name", F.col("version").cast("bigint").alias("version"), "run_id")


# =========================================================== hyper-parameter search

SPACE = {"optimizer": S.choice("Adadelta", "Adam"), "learning_rate": S.loguniform(-5, 0),
         "dropout": S.uniform(0.1, 0.9), "batch_size": S.choice(32, 64, 128)}


def _points_sql(key: str, salt: str) -> str:
    return (f"['Adadelta', 'Adam'][CAST(floor({u_sql(key, salt + 'optimizer')} * 2) AS INTEGER) + 1] AS optimizer, "
            f"exp(CAST(-5.0 AS DOUBLE) + CAST(5.0 AS DOUBLE) * {u_sql(key, salt + 'learning_rate')}) AS learning_rate, "
            f"CAST(0.1 AS DOUBLE) + CAST(0.8 AS DOUBLE) * {u_sql(key, salt + 'dropout')} AS dropout, "
            f"[32, 64, 128][CAST(floor({u_sql(key, salt + 'batch_size')} * 3) AS INTEGER) + 1] AS batch_size")


def _trials(spark, d):
    """One trial per brand: parameters hashed from the brand, accuracy from
    its parts; every fifth brand number is a failed trial (null loss)."""
    p = T(spark, d, "part")
    t = p.groupBy("p_brand").agg(F.avg(F.when(F.col("p_size") > 25, 1.0).otherwise(0.0)).alias("accuracy"))
    tid = F.substring("p_brand", 7, 10).cast("bigint")
    ok = (tid % 5) != 0
    return t.select(tid.alias("trial_id"), *S.point_columns("p_brand", SPACE, "trial:"),
                    F.round("accuracy", 6).alias("accuracy"),
                    F.when(ok, -F.round("accuracy", 6)).alias("loss"),
                    F.when(ok, F.lit("ok")).otherwise(F.lit("fail")).alias("status"))


_TRIALS_SQL = f"""trials AS (
  SELECT CAST(substr(p_brand, 7) AS BIGINT) AS trial_id, {_points_sql('p_brand', 'trial:')},
         round(avg(CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
         CASE WHEN CAST(substr(p_brand, 7) AS BIGINT) % 5 <> 0 THEN -round(avg(CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END), 6) END AS loss,
         CASE WHEN CAST(substr(p_brand, 7) AS BIGINT) % 5 <> 0 THEN 'ok' ELSE 'fail' END AS status
  FROM part GROUP BY p_brand)"""


@register("search_space_points", f"""
SELECT p_partkey, optimizer, round(learning_rate, 9) AS learning_rate, round(dropout, 9) AS dropout, batch_size
FROM (SELECT p_partkey, {_points_sql('p_partkey', 'point:')} FROM part)""")
def q_search_space_points(spark, d):
    """H1/H6: search-space points hashed from a key."""
    p = T(spark, d, "part").select("p_partkey", *S.point_columns("p_partkey", SPACE, "point:"))
    return p.select("p_partkey", "optimizer", F.round("learning_rate", 9).alias("learning_rate"),
                    F.round("dropout", 9).alias("dropout"), "batch_size")


@register("negated_objective", f"""
WITH {_TRIALS_SQL} SELECT trial_id, accuracy, -accuracy AS loss FROM trials""")
def q_negated_objective(spark, d):
    """loss = -accuracy per trial."""
    t = _trials(spark, d)
    return t.select("trial_id", "accuracy", C.negate("accuracy").alias("loss"))


@register("best_trial", f"""
WITH {_TRIALS_SQL}
SELECT trial_id, loss, optimizer, round(learning_rate, 9) AS learning_rate, round(dropout, 9) AS dropout, batch_size
FROM trials WHERE status = 'ok' AND loss IS NOT NULL ORDER BY loss, trial_id LIMIT 1""")
def q_best_trial(spark, d):
    """Argmin of loss over successful trials (ties by id)."""
    b = S.best_trial(_trials(spark, d), list(SPACE))
    return b.select("trial_id", "loss", "optimizer", F.round("learning_rate", 9).alias("learning_rate"),
                    F.round("dropout", 9).alias("dropout"), "batch_size")


@register("failed_trials_excluded", f"""
WITH {_TRIALS_SQL}
SELECT count(*) AS n_trials, count(*) FILTER (WHERE status <> 'ok') AS n_failed,
       (SELECT trial_id FROM trials WHERE status = 'ok' ORDER BY loss, trial_id LIMIT 1) AS best_trial_id
FROM trials""")
def q_failed_trials_excluded(spark, d):
    """H7: failed trials keep a row but never win."""
    t = _trials(spark, d)
    best = S.best_trial(t, list(SPACE)).select("trial_id").scalar()
    return t.agg(F.count(F.lit(1)).alias("n_trials"),
                 F.count(F.when(F.col("status") != "ok", 1)).alias("n_failed")) \
            .select("n_trials", "n_failed", best.alias("best_trial_id"))


@register("best_params_logged", f"""
WITH {_TRIALS_SQL},
b AS (SELECT * FROM trials WHERE status = 'ok' ORDER BY loss, trial_id LIMIT 1)
SELECT 'optimizer' AS key, CAST(NULL AS DOUBLE) AS num_value, optimizer AS str_value FROM b
UNION ALL SELECT 'learning_rate', round(learning_rate, 9), NULL FROM b
UNION ALL SELECT 'dropout', round(dropout, 9), NULL FROM b
UNION ALL SELECT 'batch_size', CAST(batch_size AS DOUBLE), NULL FROM b""")
def q_best_params_logged(spark, d):
    """H8: best parameters logged as values, not indexes."""
    b = S.best_trial(_trials(spark, d), list(SPACE))
    rows = F.array(
        F.struct(F.lit("optimizer").alias("key"), F.lit(None).cast("double").alias("num_value"),
                 F.col("optimizer").alias("str_value")),
        *[F.struct(F.lit(k).alias("key"), v.alias("num_value"), F.lit(None).cast("string").alias("str_value"))
          for k, v in (("learning_rate", F.round("learning_rate", 9)), ("dropout", F.round("dropout", 9)),
                       ("batch_size", F.col("batch_size").cast("double")))])
    return b.select(F.inline(rows))


@register("tpe_density_ratio", f"""
WITH {_TRIALS_SQL},
ok AS (SELECT * FROM trials WHERE status = 'ok' AND loss IS NOT NULL),
lab AS (SELECT *, (row_number() OVER (ORDER BY loss, trial_id) - 1) <
                  greatest(1, ceil((SELECT count(*) FROM ok) * 0.25)) AS good FROM ok),
cand AS (SELECT p_name, {_points_sql('p_name', 'cand:')} FROM (SELECT DISTINCT p_name FROM part)),
pairs AS (SELECT c.p_name, l.good,
                 exp(-power((ln(c.learning_rate) + 5.0) / 5.0 - (ln(l.learning_rate) + 5.0) / 5.0, 2) / 0.08) AS k_lr,
                 exp(-power((c.dropout - 0.1) / 0.8 - (l.dropout - 0.1) / 0.8, 2) / 0.08) AS k_do,
                 CASE WHEN c.optimizer = l.optimizer THEN 1 ELSE 0 END AS m_opt,
                 CASE WHEN c.batch_size = l.batch_size THEN 1 ELSE 0 END AS m_bs
          FROM cand c CROSS JOIN lab l),
agg AS (SELECT p_name,
               sum(CASE WHEN good THEN 1 ELSE 0 END) AS n_l, sum(CASE WHEN good THEN 0 ELSE 1 END) AS n_g,
               sum(CASE WHEN good THEN k_lr ELSE 0 END) AS kl_lr, sum(CASE WHEN good THEN 0 ELSE k_lr END) AS kg_lr,
               sum(CASE WHEN good THEN k_do ELSE 0 END) AS kl_do, sum(CASE WHEN good THEN 0 ELSE k_do END) AS kg_do,
               sum(CASE WHEN good THEN m_opt ELSE 0 END) AS ml_opt, sum(CASE WHEN good THEN 0 ELSE m_opt END) AS mg_opt,
               sum(CASE WHEN good THEN m_bs ELSE 0 END) AS ml_bs, sum(CASE WHEN good THEN 0 ELSE m_bs END) AS mg_bs
        FROM pairs GROUP BY p_name)
SELECT p_name, round(
    ln((ml_opt + 1.0) / (n_l + 2)) - ln((mg_opt + 1.0) / (n_g + 2))
  + ln((kl_lr * {1 / (0.2 * math.sqrt(2 * math.pi))!r} + 1.0) / (n_l + 1.0)) - ln((kg_lr * {1 / (0.2 * math.sqrt(2 * math.pi))!r} + 1.0) / (n_g + 1.0))
  + ln((kl_do * {1 / (0.2 * math.sqrt(2 * math.pi))!r} + 1.0) / (n_l + 1.0)) - ln((kg_do * {1 / (0.2 * math.sqrt(2 * math.pi))!r} + 1.0) / (n_g + 1.0))
  + ln((ml_bs + 1.0) / (n_l + 3)) - ln((mg_bs + 1.0) / (n_g + 3)), 6) + 0.0 AS score
FROM agg""")
def q_tpe_density_ratio(spark, d):
    """H5: Parzen-estimator score of every candidate."""
    names = T(spark, d, "part").select("p_name").distinct()
    cands = names.select("p_name", *S.point_columns("p_name", SPACE, "cand:"))
    scored = S.tpe_scores(cands, _trials(spark, d), SPACE, gamma=0.25, bw=0.2)
    return scored.select("p_name", _r6("score").alias("score"))


def _running(trials: DataFrame) -> DataFrame:
    """The trials with every tenth one still running."""
    return trials.withColumn("status", F.when(F.col("trial_id") % 10 == 0, "running").otherwise(F.col("status")))


def _parzen_sql() -> str:
    """Both sides' kernels and options of the trials, draws from the good side
    and their scores, as joins."""
    unit = {"learning_rate": "(ln(learning_rate) + 5.0) / 5.0", "dropout": "(dropout - 0.1) / 0.8"}
    draws = ", ".join(f"{u_sql('p_partkey', f'p:{n}:{x}')} AS {n}_{x}"
                      for n in ("optimizer", "learning_rate", "dropout", "batch_size") for x in ("which", "where"))
    observed = " UNION ALL ".join(f"SELECT '{n}' AS par, good, {u} AS v, 0 AS prior FROM lab" for n, u in unit.items())
    priors = " UNION ALL ".join(f"SELECT '{n}', {g}, 0.5, 1" for n in unit for g in ("true", "false"))
    options = {"optimizer": "['Adadelta', 'Adam']", "batch_size": "[32, 64, 128]"}
    size = {"optimizer": 2, "batch_size": 3}

    def number(n, back):
        return f"""{n}_x AS (SELECT p_partkey, least(greatest(v + scale * ln((low + {n}_where * span) / (1 - (low + {n}_where * span))), 0), 1) AS {n}_u
  FROM draws JOIN cut ON par = '{n}' AND good AND slot = least(floor({n}_which * n), n - 1)),
{n}_d AS (SELECT p_partkey, any_value({n}_u) AS {n}_u, {back} AS {n},
       {"".join(f", sum(CASE WHEN {g} THEN w * e / ((1 + e) * (1 + e) * scale * span) END) / any_value(n_{s}) AS {n}_{s}" for s, g in (("good", "good"), ("bad", "NOT good")))[2:]}
  FROM (SELECT *, exp(-abs(({n}_u - v) / scale)) AS e FROM {n}_x JOIN cut ON par = '{n}')
  JOIN (SELECT max(CASE WHEN good THEN n END) AS n_good, max(CASE WHEN NOT good THEN n END) AS n_bad FROM cut WHERE par = '{n}') ON true
  GROUP BY p_partkey)"""

    def option(n):
        k = size[n]
        return f"""{n}_d AS (SELECT p_partkey, x AS {n},
       ((SELECT count(*) FROM lab WHERE good AND {n} = x) + 1.0) / (n_good + {k}) AS {n}_good,
       ((SELECT count(*) FROM lab WHERE NOT good AND {n} = x) + 1.0) / (n_bad + {k}) AS {n}_bad
  FROM (SELECT p_partkey, n_good, n_bad, coalesce(l.{n}, {options[n]}[least(CAST(floor({n}_which * (n_good + {k}) - n_good) AS INTEGER), {k - 1}) + 1]) AS x
        FROM draws CROSS JOIN (SELECT count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE NOT good) AS n_bad FROM lab)
        LEFT JOIN (SELECT {n}, r FROM lab WHERE good) l ON l.r = floor({n}_which * (n_good + {k}))))"""

    return f"""
WITH {_TRIALS_SQL},
st AS (SELECT * REPLACE (CASE WHEN trial_id % 10 = 0 THEN 'running' ELSE status END AS status) FROM trials),
done AS (SELECT *, row_number() OVER (ORDER BY loss, trial_id) - 1 AS r, count(*) OVER () AS n_ok
         FROM st WHERE status = 'ok' AND loss IS NOT NULL),
lab AS (SELECT * EXCLUDE (n_ok), r < greatest(1, ceil(n_ok * 0.25)) AS good FROM done
        UNION ALL SELECT *, NULL, false FROM st WHERE status = 'running'),
obs AS ({observed} UNION ALL {priors}),
near AS (SELECT *, lag(v) OVER w AS before, lead(v) OVER w AS behind, count(*) OVER (PARTITION BY par, good) AS n,
                row_number() OVER (PARTITION BY par, good ORDER BY prior, v) - 1 AS slot
         FROM obs WINDOW w AS (PARTITION BY par, good ORDER BY v, prior)),
kern AS (SELECT *, 1.0 AS w, {PZ.LOGISTIC!r} * CASE WHEN prior = 1 THEN 1.0 ELSE
           least(1.0, greatest(1.0 / least(100.0, n + 1.0), coalesce(v - before, 0), coalesce(behind - v, 0))) END AS scale FROM near),
cut AS (SELECT *, 1 / (1 + exp(v / scale)) AS low, 1 / (1 + exp(-(1 - v) / scale)) - 1 / (1 + exp(v / scale)) AS span FROM kern),
draws AS (SELECT p_partkey, {draws} FROM part),
{number("learning_rate", "any_value(exp(-5.0 + 5.0 * learning_rate_u))")},
{number("dropout", "any_value(0.1 + 0.8 * dropout_u)")},
{option("optimizer")},
{option("batch_size")}
SELECT p_partkey, optimizer, round(learning_rate, 6) + 0.0 AS learning_rate, round(dropout, 6) + 0.0 AS dropout, batch_size,
       round(ln(optimizer_good) - ln(optimizer_bad) + ln(learning_rate_good) - ln(learning_rate_bad)
             + ln(dropout_good) - ln(dropout_bad) + ln(batch_size_good) - ln(batch_size_bad), 6) + 0.0 AS score
FROM learning_rate_d JOIN dropout_d USING (p_partkey) JOIN optimizer_d USING (p_partkey) JOIN batch_size_d USING (p_partkey)"""


@register("adaptive_candidates", _parzen_sql())
def q_adaptive_candidates(spark, d):
    """H5: candidates drawn from the good trials' densities (a bandwidth per
    kernel, running trials on the bad side) and their scores, one lazy plan."""
    model = PZ.parzen_model(_running(_trials(spark, d)), SPACE)
    keys = T(spark, d, "part").select("p_partkey")
    scored = PZ.score(PZ.draw(keys, "p_partkey", model, SPACE, "p:"), model, SPACE)
    return scored.select("p_partkey", "optimizer", _r6("learning_rate").alias("learning_rate"),
                         _r6("dropout").alias("dropout"), "batch_size", _r6("score").alias("score"))


@register("kernel_bandwidths", f"""
WITH {_TRIALS_SQL},
done AS (SELECT *, row_number() OVER (ORDER BY loss, trial_id) - 1 AS r, count(*) OVER () AS n_ok FROM trials WHERE status = 'ok'),
obs AS (SELECT (dropout - 0.1) / 0.8 AS v, 0 AS prior FROM done WHERE r < greatest(1, ceil(n_ok * 0.25)) UNION ALL SELECT 0.5, 1),
near AS (SELECT *, lag(v) OVER w AS before, lead(v) OVER w AS behind, count(*) OVER () AS n FROM obs WINDOW w AS (ORDER BY v, prior))
SELECT round(v, 9) AS value, round(CASE WHEN prior = 1 THEN 1.0 ELSE least(1.0, greatest(1.0 / least(100.0, n + 1.0),
       coalesce(v - before, 0), coalesce(behind - v, 0))) END, 9) AS bandwidth FROM near""")
def q_kernel_bandwidths(spark, d):
    """H5: the good side's kernels of one parameter, each with its own bandwidth."""
    model = PZ.parzen_model(_trials(spark, d), {"dropout": SPACE["dropout"]})
    return model.select(F.inline("good_dropout")).select(
        F.round("value", 9).alias("value"), F.round(F.col("scale") / F.lit(PZ.LOGISTIC), 9).alias("bandwidth"))


# =========================================================== files and images


@register("binary_file_scan", """
SELECT 'lang=' || lang AS label, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY 1""")
def q_binary_file_scan(spark, d):
    """Documents written as text files in one directory per language (by
    Spark), then scanned back as binary rows: glob, recursive lookup, label
    from the parent directory."""
    root = scratch_path(spark, "docs_as_files")
    docs = T(spark, d, "documents")
    docs.select("lang", "text").write.mode("overwrite").partitionBy("lang").text(root)
    files = FS.binary_files(spark, root, glob="*.txt", recursive=True)
    silver = prepare.with_label_from_path(files.select("path", "length"), "path")
    return silver.groupBy("label").agg(F.sum("length").alias("n_bytes"))


def _quantised(spark, d):
    e = T(spark, d, "embeddings")
    q = F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(
        F.lit(0), F.floor((x.cast("double") + F.lit(1.0)) * F.lit(127.5)).cast("int"))))
    # RGB triples with distinct channels, so a channel-order slip shows up
    px = F.flatten(F.transform(q, lambda v: F.array(v, F.lit(255) - v, (v * 7) % 256)))
    rel = F.concat(F.lit("class_"), F.col("label").cast("string"), F.lit("/"),
                   F.col("vec_id").cast("string"), F.lit(".png"))
    return e.select("vec_id", "label", rel.alias("rel"), px.alias("pixels"))


def _images_from_embeddings(spark, d):
    """Every embedding row becomes an 8x8 RGB PNG under its class folder,
    written by the executors, then decoded by Spark's image source."""
    root = scratch_path(spark, "png")
    written = FS.write_png_files(_quantised(spark, d), root, "rel", "pixels", 8, 8)
    written.agg(F.count(F.lit(1))).collect()      # action: the files exist after this
    return root, FS.image_files(spark, root, glob="*.png", recursive=True)


_Q_SQL = "least(255, greatest(0, CAST(floor((CAST(x AS DOUBLE) + 1.0) * 127.5) AS INTEGER)))"


@register("image_decode", f"""
SELECT vec_id, 'class_' || CAST(label AS VARCHAR) AS label,
       round(avg({_Q_SQL}), 6) AS r_mean, round(avg(255 - {_Q_SQL}), 6) AS g_mean,
       round(avg(({_Q_SQL} * 7) % 256), 6) AS b_mean
FROM (SELECT vec_id, label, unnest(embedding) AS x FROM embeddings) GROUP BY vec_id, label""")
def q_image_decode(spark, d):
    """Rows -> PNG files -> JVM decode -> RGB channel means."""
    _, imgs = _images_from_embeddings(spark, d)
    means = FE.channel_means(imgs, keep=("path",))
    return means.select(
        F.regexp_extract("path", r"/(\d+)\.png$", 1).cast("bigint").alias("vec_id"),
        C.label_from_path("path").alias("label"),
        F.round("r_mean", 6).alias("r_mean"), F.round("g_mean", 6).alias("g_mean"),
        F.round("b_mean", 6).alias("b_mean"))


@register("featurise_images")
def q_featurise_images(spark, d):
    """Decoded PNGs -> resize to a non-square 12x16 -> scale -> 2x2 block means
    per channel (12 features) -> label from the folder."""
    _, imgs = _images_from_embeddings(spark, d)
    f = FE.featurise(imgs, height=12, width=16, grid=2, keep=("path",))
    return f.select("path", C.label_from_path("path").alias("label"), F.size("features").alias("n_features"),
                    F.round(C.array_sum("features"), 6).alias("feature_sum"))


@register("block_features", f"""
WITH px AS (
  SELECT vec_id, label, i - 1 AS p, {_Q_SQL} AS q
  FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)),
ch AS (
  SELECT vec_id, label, ((p // 8) // 4) * 2 + (p % 8) // 4 AS cell, 0 AS c, q AS v FROM px
  UNION ALL SELECT vec_id, label, ((p // 8) // 4) * 2 + (p % 8) // 4, 1, 255 - q FROM px
  UNION ALL SELECT vec_id, label, ((p // 8) // 4) * 2 + (p % 8) // 4, 2, (q * 7) % 256 FROM px),
feat AS (
  SELECT vec_id, label, cell, c, CAST(avg(CAST(v AS DOUBLE) / 127.5 - 1) AS FLOAT) AS f
  FROM ch GROUP BY vec_id, label, cell, c)
SELECT vec_id, 'class_' || CAST(label AS VARCHAR) AS label, CAST(count(*) AS INTEGER) AS n_features,
       round(sum(CAST(f AS DOUBLE)), 6) + 0.0 AS feature_sum
FROM feat GROUP BY vec_id, label""")
def q_block_features(spark, d):
    """The default frozen featuriser end to end on decoded PNGs at their
    native 8x8 size: RGB fix, scaling to [-1, 1], 2x2 block means per channel
    (12 float32 features per image)."""
    _, imgs = _images_from_embeddings(spark, d)
    f = FE.featurise(imgs, height=8, width=8, grid=2, keep=("path",))
    return f.select(F.regexp_extract("path", r"/(\d+)\.png$", 1).cast("bigint").alias("vec_id"),
                    C.label_from_path("path").alias("label"), F.size("features").alias("n_features"),
                    _r6(C.array_sum("features")).alias("feature_sum"))


@register("decode_join_report", """
SELECT count(*) AS decoded, CAST(count(*) * 64 AS BIGINT) AS n_pixels, CAST(0 AS BIGINT) AS dropped
FROM embeddings""")
def q_decode_join_report(spark, d):
    """Binary rows joined to decoded pixels on the normalised path (J5) and
    the anti-join report of files the decoder dropped (P8)."""
    root, imgs = _images_from_embeddings(spark, d)
    raw = FS.binary_files(spark, root, glob="*.png", recursive=True)
    joined = FS.with_decoded(raw.select("path", "length"), imgs.select("path", "height", "width"))
    dropped = FS.undecodable(raw.select("path"), imgs.select("path"))
    return joined.agg(F.count(F.lit(1)).alias("decoded"),
                      F.sum(F.col("height") * F.col("width")).cast("bigint").alias("n_pixels")) \
                 .select("decoded", "n_pixels", dropped.agg(F.count(F.lit(1))).scalar().alias("dropped"))


# =========================================================== training, search, scoring
def _split_indexed(spark, d):
    from flowline.plans.pipelines import embeddings_silver, prepare_tables
    return prepare_tables(embeddings_silver(spark, d), "row_id")


def _history_frame(spark, history: list, extra: dict | None = None) -> DataFrame:
    rows = [{**(extra or {}), **h} for h in history]
    return spark.createDataFrame(pd.DataFrame(rows))


@register("softmax_fit")
def q_softmax_fit(spark, d):
    """Full-batch multinomial fit (MLlib, L-BFGS), evaluated on validation."""
    t = _split_indexed(spark, d)
    fit = TR.fit_full_batch(t.train, t.num_classes, max_iter=50, reg=1e-3)
    scored = t.val.withColumn("logits", metrics.dense_logits("features", fit.weights.T.tolist(), fit.bias.tolist()))
    return metrics.loss_and_accuracy(scored)


@register("distributed_fit")
def q_distributed_fit(spark, d):
    """Synchronous data-parallel fit as in the distributed recipe: 2 shards,
    batch 256 per shard, 3 epochs, Adam with the learning rate scaled by
    workers and warmed up, dropout 0.5, plateau schedule."""
    t = _split_indexed(spark, d)
    cfg = TR.TrainConfig(epochs=3, batch_size=256, workers=2, learning_rate=1e-3, dropout=0.5,
                         warmup_epochs=5, plateau_patience=10)
    fit = TR.fit(t.train, t.val, t.num_classes, cfg)
    return _history_frame(spark, fit.history)


@register("parallel_trials")
def q_parallel_trials(spark, d):
    """TPE search over optimizer, learning rate and dropout (the concurrent
    search's space), 20 trials 4 at a time, 3 epochs, batch 32; the trials of a round are
    fused into one data pass per step."""
    t = _split_indexed(spark, d)
    base = TR.TrainConfig(epochs=3, batch_size=32, workers=2)
    space = {k: SPACE[k] for k in ("optimizer", "learning_rate", "dropout")}
    obj = S.fused_fit_objective(t.train, t.val, t.num_classes, base, metric="val_accuracy")
    with obj.cache:
        return S.run_search(spark, obj, space, max_evals=20, parallelism=4, n_startup=4, seed="par").trials


@register("concurrent_trials")
def q_concurrent_trials(spark, d):
    """H3: trials that don't wait for each other (4 at a time, each a
    distributed fit of one epoch), with the finished and running trials that
    each proposal knew of."""
    t = _split_indexed(spark, d)
    base = TR.TrainConfig(epochs=1, batch_size=256, workers=2)
    space = {k: SPACE[k] for k in ("optimizer", "learning_rate", "dropout")}
    obj = TS.fit_objective(t.train, t.val, t.num_classes, base, metric="val_accuracy")
    with obj.cache:
        found = TS.run_trials(spark, obj, TS.Proposer(space, n_startup=4, seed="con"), max_evals=12, parallelism=4)
    return found.trials.join(found.log, "trial_id")


@register("sequential_trials")
def q_sequential_trials(spark, d):
    """Sequential search (one trial at a time, each a distributed fit)
    minimising validation loss, with batch size searched; every trial writes
    per-epoch weight checkpoints to a folder named after its parameters."""
    t = _split_indexed(spark, d)
    base = TR.TrainConfig(epochs=3, batch_size=64, workers=2)
    space = {"learning_rate": S.loguniform(-5, 0), "dropout": S.uniform(0.1, 0.9),
             "batch_size": S.choice(32, 64, 128)}
    obj = S.fused_fit_objective(t.train, t.val, t.num_classes, base, metric="val_loss",
                                checkpoint_root=scratch_path(spark, "trial_checkpoints"))
    with obj.cache:
        return S.run_search(spark, obj, space, max_evals=4, parallelism=1, n_startup=2, seed="seq").trials


@register("packaged_model_scores")
def q_packaged_model_scores(spark, d):
    """Fit, package (head + vocabulary + preprocessing config), save, load,
    and score the whole table with the batch UDF (sub-batches of 128)."""
    from flowline.plans.pipelines import embeddings_silver, model_from_fit
    t = _split_indexed(spark, d)
    fit = TR.fit_full_batch(t.train, t.num_classes, max_iter=30, reg=1e-3)
    path = scratch_path(spark, "models")
    model_from_fit(fit, t.vocab, {"img_height": 224, "img_width": 224}).save(spark, path)
    loaded = PackagedModel.load(spark, path)
    scored = score(embeddings_silver(spark, d), loaded, "features", "prediction", batch_size=128)
    return scored.select("row_id", "label", "prediction")


@register("checkpoint_resume")
def q_checkpoint_resume(spark, d):
    """Two epochs with the fit's whole state stored after each, then a restart
    from the newest state for the third epoch."""
    from flowline.plans.pipelines import fit_with_checkpoints
    t = _split_indexed(spark, d)
    path = scratch_path(spark, "checkpoints")
    cfg = TR.TrainConfig(epochs=2, batch_size=32, workers=2, dropout=0.2)
    fit_with_checkpoints(spark, t.train, t.val, t.num_classes, cfg, path)
    resumed = fit_with_checkpoints(spark, t.train, t.val, t.num_classes, replace(cfg, epochs=3), path)
    TB.delete_path(spark, path)
    return _history_frame(spark, resumed.history)


@register("early_stopping_epoch", """
WITH daily AS (
  SELECT event_type AS run,
         CAST(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS INTEGER) AS epoch,
         avg(value) AS val_loss
  FROM events GROUP BY 1, 2),
series AS (
  SELECT run, list({'best': CAST(NULL AS DOUBLE), 'wait': 0, 'stop': CAST(NULL AS INTEGER), 'e': epoch, 'v': val_loss}
                   ORDER BY epoch) AS s
  FROM daily GROUP BY run),
folded AS (
  SELECT run, list_reduce(
    list_prepend({'best': CAST('inf' AS DOUBLE), 'wait': 0, 'stop': CAST(NULL AS INTEGER), 'e': -1, 'v': CAST(NULL AS DOUBLE)}, s),
    lambda acc, x: {
      'best': CASE WHEN acc.stop IS NULL AND x.v < acc.best - 0.01 THEN x.v ELSE acc.best END,
      'wait': CASE WHEN x.v < acc.best - 0.01 THEN 0 ELSE acc.wait + 1 END,
      'stop': CASE WHEN acc.stop IS NOT NULL THEN acc.stop
                   WHEN NOT (x.v < acc.best - 0.01) AND acc.wait + 1 >= 3 THEN x.e END,
      'e': x.e, 'v': x.v}) AS r
  FROM series)
SELECT run, r.stop AS stop_epoch, round(r.best, 6) + 0.0 AS best_loss FROM folded""")
def q_early_stopping_epoch(spark, d):
    """Per event type, daily mean value as an epoch metric; the early-stopping
    rule (best moves only when beaten by more than min_delta, stop after
    `patience` epochs without improvement) as a fold over each series."""
    ev = T(spark, d, "events").withColumn("day", F.to_date("ts"))
    first = ev.agg(F.min("day")).scalar()
    daily = ev.groupBy(F.col("event_type").alias("run"), F.datediff("day", first).alias("epoch")) \
              .agg(F.avg("value").alias("val_loss"))
    return early_stop_fold(daily, patience=3, min_delta=0.01)


def early_stop_fold(epoch_metrics: DataFrame, patience: int, min_delta: float,
                    run: str = "run", epoch: str = "epoch", value: str = "val_loss") -> DataFrame:
    """Spark form of ``trainer.early_stop_epoch``: one row per run with the
    stop epoch (null if never) and the best value.  Each run's series is as
    long as its epoch count, so collecting it per group is bounded."""
    series = epoch_metrics.groupBy(run).agg(
        F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("e"), F.col(value).alias("v")))).alias("s"))
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("wait"),
                    F.lit(None).cast("int").alias("stop"))

    def step(acc, x):
        improved = x["v"] < acc["best"] - F.lit(min_delta)
        wait = F.when(improved, F.lit(0)).otherwise(acc["wait"] + 1)
        stop = F.when(acc["stop"].isNotNull(), acc["stop"]) \
                .when(~improved & (wait >= patience), x["e"].cast("int"))
        best = F.when(acc["stop"].isNull() & improved, x["v"]).otherwise(acc["best"])
        return F.struct(best.alias("best"), wait.alias("wait"), stop.alias("stop"))

    out = series.select(run, F.aggregate("s", init, step).alias("r"))
    return out.select(run, F.col("r.stop").alias("stop_epoch"), _r6("r.best").alias("best_loss"))


@register("adam_step1", f"""
WITH {_GRAD_SQL}
SELECT k, pos, round(-0.01 * sqrt(1 - 0.999) / (1 - 0.9) * (0.1 * g) / (sqrt(0.001 * g * g) + 1e-7), 6) + 0.0 AS w
FROM grad""")
def q_adam_step1(spark, d):
    """M4: Adam's first step from zero, on the all-reduced gradient."""
    return _first_step(spark, d, "adam", 0.01)


@register("adadelta_step1", f"""
WITH {_GRAD_SQL}
SELECT k, pos, round(-1.0 * sqrt(1e-7) / sqrt(0.05 * g * g + 1e-7) * g, 6) + 0.0 AS w FROM grad""")
def q_adadelta_step1(spark, d):
    """M5: Adadelta's first step from zero, on the all-reduced gradient."""
    return _first_step(spark, d, "adadelta", 1.0)


def _first_step(spark, d, optimizer, lr):
    g, _, _ = TR.gradient(_emb_features(spark, d), np.zeros((DIM, NUM_CLASSES)))
    w = TR.Optimizer(optimizer, g.shape).update(np.zeros_like(g), g, lr)
    rows = TB.weights_frame(spark, optimizer, w[:DIM], w[DIM])
    return rows.select("k", "pos", (F.round("w", 6) + F.lit(0.0)).alias("w"))


def _scored_sql(weights: str, out: str) -> str:
    """SQL of every row's probabilities, loss and hit under a weights table."""
    return f"""{out}_lg AS (
  SELECT r.vec_id, any_value(r.label) AS label, w.k, sum(CAST(r.x AS DOUBLE) * w.w) + any_value(b.w) AS logit
  FROM rows r JOIN {weights} w ON r.pos = w.pos JOIN (SELECT k, w FROM {weights} WHERE pos = {DIM}) b ON b.k = w.k
  GROUP BY r.vec_id, w.k),
{out}_p AS (
  SELECT vec_id, label, k, logit, mx, exp(logit - mx) / sum(exp(logit - mx)) OVER (PARTITION BY vec_id) AS p
  FROM (SELECT *, max(logit) OVER (PARTITION BY vec_id) AS mx FROM {out}_lg)),
{out} AS (
  SELECT avg(ce) AS loss, avg(hit) AS accuracy FROM (
    SELECT -ln(max(CASE WHEN k = label THEN p END)) AS ce,
           CASE WHEN arg_max(k, logit) = any_value(label) THEN 1.0 ELSE 0.0 END AS hit
    FROM {out}_p GROUP BY vec_id))"""


@register("sgd_two_epochs", f"""
WITH {_GRAD_SQL},
w1 AS (SELECT k, pos, -0.5 * g AS w FROM grad),
{_scored_sql('w1', 's1')},
g2 AS (
  SELECT s.k, r.pos, sum(CAST(r.x AS DOUBLE) * (p - CASE WHEN s.label = s.k THEN 1.0 ELSE 0.0 END)) / (SELECT n FROM n) AS g
  FROM s1_p s JOIN rows r ON r.vec_id = s.vec_id GROUP BY s.k, r.pos
  UNION ALL
  SELECT k, {DIM} AS pos, sum(p - CASE WHEN label = k THEN 1.0 ELSE 0.0 END) / (SELECT n FROM n) AS g FROM s1_p GROUP BY k),
w2 AS (SELECT k, pos, w - 0.5 * g AS w FROM w1 JOIN g2 USING (k, pos)),
{_scored_sql('w2', 's2')}
SELECT 0 AS epoch, round(ln({NUM_CLASSES}.0), 6) AS loss,
       round((SELECT avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) FROM embeddings), 6) AS accuracy,
       round(loss, 6) AS val_loss, round(accuracy, 6) AS val_accuracy FROM s1
UNION ALL
SELECT 1, round(s1.loss, 6), round(s1.accuracy, 6), round(s2.loss, 6), round(s2.accuracy, 6) FROM s1, s2""")
def q_sgd_two_epochs(spark, d):
    """The trainer's history over two epochs of one full-batch SGD
    step each, from zero: training figures before, validation after a step."""
    fit = _two_epochs(spark, d)
    cols = ["loss", "accuracy", "val_loss", "val_accuracy"]
    return _history_frame(spark, fit.history).select(F.col("epoch").cast("int"), *[_r6(c).alias(c) for c in cols])


def _two_epochs(spark, d):
    data = _emb_features(spark, d)
    n = T(spark, d, "embeddings").count()
    cfg = TR.TrainConfig(epochs=2, batch_size=n, workers=1, learning_rate=0.5, optimizer="sgd", dropout=0.0,
                         scale_lr=False)
    return TR.fit(data, data, NUM_CLASSES, cfg, init=np.zeros((DIM + 1, NUM_CLASSES)))


@register("active_run_history", ORACLE["sgd_two_epochs"])
def q_active_run_history(spark, d):
    """The same fit inside an active run, which logs by itself: its
    history as the run tables have it."""
    store = R.RunStore(spark, scratch_path(spark, "active"))
    with store.active_run("two epochs"):
        _two_epochs(spark, d)
    cols = ["loss", "accuracy", "val_loss", "val_accuracy"]
    return (store.table("run_metrics").groupBy(F.col("step").cast("int").alias("epoch"))
            .agg(*[_r6(F.max(F.when(F.col("key") == c, F.col("value")))).alias(c) for c in cols]))


def _local_sql(steps: int, local: int, rate: float) -> str:
    """Two shards' gradient steps, unrolled: a shard's own weights move within
    a round of ``local`` steps, and are averaged behind it."""
    parts = [f"""
WITH b AS (SELECT count(*) // {2 * steps} AS b FROM embeddings),
shards AS (SELECT vec_id, embedding, label, {u32_sql('vec_id', 'shard')} % 2 AS shard,
                  row_number() OVER (PARTITION BY {u32_sql('vec_id', 'shard')} % 2 ORDER BY {u32_sql('vec_id', 'order')}, vec_id) - 1 AS place
           FROM embeddings),
feed AS (SELECT shard, f, f // b AS step, embedding, label
         FROM (SELECT shard, count(*) AS n FROM shards GROUP BY shard) JOIN (SELECT b, unnest(range({steps} * b)) AS f FROM b) ON true
         JOIN shards USING (shard) WHERE place = f % n),
cells AS (SELECT shard, f, step, label, unnest(range({DIM})) AS pos, unnest(embedding) AS x FROM feed
          UNION ALL SELECT shard, f, step, label, {DIM}, 1.0 FROM feed),
w0 AS (SELECT shard, k, pos, 0.0 AS w FROM range(2) s(shard), range({NUM_CLASSES}) c(k), range({DIM + 1}) p(pos))"""]
    for t in range(steps):
        moved = f"m{t}" if (t + 1) % local == 0 else f"w{t + 1}"
        parts.append(f"""
l{t} AS (SELECT c.shard, f, any_value(label) AS label, k, sum(CAST(x AS DOUBLE) * w) AS z
        FROM cells c JOIN w{t} w ON w.shard = c.shard AND w.pos = c.pos WHERE step = {t} GROUP BY c.shard, f, k),
p{t} AS (SELECT shard, f, k, exp(z) / sum(exp(z)) OVER (PARTITION BY shard, f) - CASE WHEN label = k THEN 1.0 ELSE 0.0 END AS r FROM l{t}),
{moved} AS (SELECT w.shard, w.k, w.pos, w - {rate} * g AS w FROM w{t} w JOIN (
        SELECT c.shard, k, pos, sum(CAST(x AS DOUBLE) * r) / (SELECT b FROM b) AS g
        FROM cells c JOIN p{t} p ON p.shard = c.shard AND p.f = c.f GROUP BY c.shard, k, pos) USING (shard, k, pos))""")
        if moved == f"m{t}":
            parts.append(f"""
w{t + 1} AS (SELECT shard, k, pos, avg(w) OVER (PARTITION BY k, pos) AS w FROM m{t})""")
    return ",".join(parts) + f"""
SELECT k, pos, round(w, 6) + 0.0 AS w FROM w{steps} WHERE shard = 0"""


@register("local_step_rounds", _local_sql(4, 2, 0.5))
def q_local_step_rounds(spark, d):
    """M6: two rounds of two local SGD steps on two shards, weights averaged
    after each round (one job a round)."""
    n = T(spark, d, "embeddings").count()
    cfg = TR.TrainConfig(epochs=1, batch_size=n // 8, workers=2, learning_rate=0.5, optimizer="sgd", dropout=0.0,
                         scale_lr=False, local_steps=2)
    fit = TR.fit(_emb_features(spark, d), None, NUM_CLASSES, cfg, init=np.zeros((DIM + 1, NUM_CLASSES)))
    rows = TB.weights_frame(spark, "local", fit.weights, fit.bias)
    return rows.select("k", "pos", (F.round("w", 6) + F.lit(0.0)).alias("w"))


@register("weights_round_trip", f"""
WITH {_GRAD_SQL} SELECT k, pos, round(-0.5 * g, 6) + 0.0 AS w FROM grad""")
def q_weights_round_trip(spark, d):
    """One SGD step from zero computed by the all-reduce, saved as a weights
    table and read back."""
    data = _emb_features(spark, d)
    g, _, _ = TR.gradient(data, np.zeros((DIM, NUM_CLASSES)))
    w1 = -0.5 * g
    path = scratch_path(spark, "weights")
    TB.save_weights(spark, path, "step1", w1[:DIM], w1[DIM])
    back = spark.read.parquet(path).filter(F.col("run_id") == "step1")
    return back.select("k", "pos", (F.round("w", 6) + F.lit(0.0)).alias("w"))


@register("score_table", f"""
WITH {_LOGITS_SQL}
SELECT vec_id, 'class_' || CAST(any_value(label) AS VARCHAR) AS label,
       'class_' || CAST(arg_max(k, logit) AS VARCHAR) AS prediction
FROM logits GROUP BY vec_id""")
def q_score_table(spark, d):
    """Batch scoring of the whole table with a packaged head (fixed sine
    weights) through predict_batch_udf; class names from the vocabulary."""
    return _scored(spark, d, lambda model: model)


@register("sql_model_function", ORACLE["score_table"])
def q_sql_model_function(spark, d):
    """The same head logged, registered, promoted, and called from SQL
    through its address."""
    silver, model = _fixed_head(spark, d)
    store = R.RunStore(spark, scratch_path(spark, "served"))
    with store.run("fixed head") as run:
        store.log_model(run, model)
    store.transition_stage("head", store.register_model("head", run), "Production")
    register_function(spark, store, "models:/head/production", "predict_label")
    return spark.sql("SELECT row_id AS vec_id, label, predict_label(features) AS prediction FROM {silver}", silver=silver)


@register("packaged_model_round_trip", ORACLE["score_table"])
def q_packaged_model_round_trip(spark, d):
    """The same head saved, loaded and scored."""
    path = scratch_path(spark, "models")

    def saved(model):
        model.save(spark, path)
        return PackagedModel.load(spark, path)

    return _scored(spark, d, saved)


def _fixed_head(spark, d):
    """(rows, the packaged head of fixed sine weights)."""
    from flowline.plans.pipelines import embeddings_silver
    silver = embeddings_silver(spark, d)
    vocab = prepare.build_vocab(silver)
    classes = [r.label for r in vocab.orderBy("label_idx").collect()]   # bounded: K rows
    w = np.array(metrics.sine_weights(DIM, NUM_CLASSES)).T
    return silver, PackagedModel(w, np.zeros(NUM_CLASSES), classes, {"img_height": 224, "img_width": 224})


def _scored(spark, d, through):
    silver, model = _fixed_head(spark, d)
    out = score(silver, through(model), "features", "prediction", batch_size=128)
    return out.select(F.col("row_id").alias("vec_id"), "label", "prediction")


@register("worker_partitions", """
SELECT CAST(2 AS BIGINT) AS n_partitions, count(*) AS n_rows FROM embeddings""")
def q_worker_partitions(spark, d):
    """Repartition to the worker count before training (round-robin): every
    row lands in one of the 2 partitions."""
    e = feed.repartition_for_workers(T(spark, d, "embeddings"), 2)
    per = e.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("n").alias("n_rows"))


@register("bernoulli_sample")
def q_bernoulli_sample(spark, d):
    """Seeded Bernoulli sample (keywords, so the seed is honoured)."""
    return prepare.bernoulli_sample(T(spark, d, "documents"), 0.5, seed=1).select("doc_id")


@register("random_split_is_partition", """
SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_ids FROM embeddings""")
def q_random_split_is_partition(spark, d):
    """The two parts of a random split hold each row once, together all."""
    tr, va = prepare.random_split(T(spark, d, "embeddings"), (0.9, 0.1), 42)
    both = tr.select("vec_id").union(va.select("vec_id"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("vec_id").alias("n_ids"))


@register("random_split_parity")
def q_random_split_parity(spark, d):
    """randomSplit([0.9, 0.1], seed=42) for parity; sizes only (layout-dependent)."""
    tr, va = prepare.random_split(T(spark, d, "embeddings"), (0.9, 0.1), 42)
    return tr.select(F.lit("train").alias("split")).unionByName(va.select(F.lit("val").alias("split"))) \
             .groupBy("split").count()
