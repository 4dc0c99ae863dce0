"""End-to-end plans.

* ``prepare_tables``  -- Entry A: bronze -> silver -> train/val + vocabulary
* ``train``           -- Entry B: snapshot, synchronous data-parallel fit
* ``score_table``     -- Entry C: packaged model over a whole table
* ``flagship``        -- the smallest slice through every layer, on the
  ``embeddings`` table (pooled features + class): split, vocabulary, index,
  fit, score the validation rows, accuracy per class.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.operators import prepare
from flowline.operators import trainer as TR
from flowline.operators.infer import PackagedModel, score


@dataclass
class PreparedTables:
    train: DataFrame
    val: DataFrame
    vocab: DataFrame
    num_classes: int


def prepare_tables(silver: DataFrame, key: str, label_col: str = "label",
                   weights=(0.9, 0.1), handle_unseen: str = "error") -> PreparedTables:
    """Split silver rows by a hash of ``key``, build the vocabulary from the
    training split only, index both splits."""
    train, val = prepare.hash_split(silver, key, weights)
    vocab = prepare.build_vocab(train, label_col)
    k = vocab.count()
    return PreparedTables(
        train=prepare.index_labels(train, vocab, label_col, handle_unseen="error"),
        val=prepare.index_labels(val, vocab, label_col, handle_unseen=handle_unseen),
        vocab=vocab, num_classes=k)


def embeddings_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as silver rows: key, features, class name."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"),
                    F.concat(F.lit("class_"), F.col("label").cast("string")).alias("label"))


def model_from_fit(fit: TR.FitResult, vocab: DataFrame, preprocess: dict | None = None) -> PackagedModel:
    classes = [r.label for r in vocab.orderBy("label_idx").collect()]   # K rows
    return PackagedModel(fit.weights, fit.bias, classes, preprocess or {})


def flagship(spark: SparkSession, sf_dir: str, config: TR.TrainConfig | None = None) -> DataFrame:
    tables = prepare_tables(embeddings_silver(spark, sf_dir), "row_id")
    cfg = config or TR.TrainConfig(epochs=3, batch_size=32, workers=2, learning_rate=1e-2,
                                   dropout=0.1, seed=42)
    fit = TR.fit(tables.train, tables.val, tables.num_classes, cfg)
    model = model_from_fit(fit, tables.vocab)
    scored = score(tables.val, model, "features", "prediction")
    return (scored.groupBy("label")
                  .agg(F.count(F.lit(1)).alias("n_rows"),
                       F.round(F.avg((F.col("prediction") == F.col("label")).cast("double")), 6)
                        .alias("accuracy"))
                  .orderBy("label"))


# ---------------------------------------------------------------- Entry A / C on image files
def ingest_images(spark: SparkSession, image_dir: str, database: str, glob: str = "*.jpg",
                  fmt: str = "parquet", sample_fraction: float | None = None,
                  location: str | None = None, weights=(0.9, 0.1), handle_unseen: str = "error",
                  materialize: bool = False) -> PreparedTables:
    """Files -> bronze -> silver -> train/val (+label_idx) and the vocabulary,
    as tables/views of ``database``.

    The image bytes are written ONCE: bronze carries the path-derived
    ``label`` and the hash ``split`` and is partitioned by split; ``silver``,
    ``silver_train`` and ``silver_val`` are views over it (the latter two
    joined to the stored vocabulary), so reading the validation rows prunes
    to their partition.  ``materialize=True`` writes the three as tables
    instead (four copies of the bytes, as the original workflow does)."""
    from flowline.sources import files as FS
    from flowline.sources import tables as TB

    raw = FS.binary_files(spark, image_dir, glob=glob, recursive=True)
    if sample_fraction is not None:
        raw = prepare.hash_sample(raw, "path", sample_fraction)
    TB.create_database(spark, database, location)
    if materialize:
        TB.save_table(raw, f"{database}.bronze", fmt, compression="uncompressed")
        silver = prepare.with_label_from_path(spark.table(f"{database}.bronze"), "path")
        TB.save_table(silver, f"{database}.silver", fmt, compression="uncompressed")
        t = prepare_tables(spark.table(f"{database}.silver"), "path", weights=weights,
                           handle_unseen=handle_unseen)
        TB.save_table(t.train, f"{database}.silver_train", fmt, compression="uncompressed")
        TB.save_table(t.val, f"{database}.silver_val", fmt, compression="uncompressed")
        TB.save_table(t.vocab, f"{database}.vocab", fmt)
    else:
        bronze = (prepare.with_label_from_path(raw, "path")
                  .withColumn("split", prepare.split_column("path", weights, ("train", "val"))))
        TB.save_table(bronze, f"{database}.bronze", fmt, compression="uncompressed",
                      partition_by=["split"])
        b = spark.table(f"{database}.bronze")
        vocab = prepare.build_vocab(b.where(F.col("split") == "train").select("label"))
        TB.save_table(vocab, f"{database}.vocab", fmt)
        k = spark.table(f"{database}.vocab").count()
        cols = "b.path, b.modificationTime, b.length, b.content, b.label"
        unseen = {"error": "CASE WHEN v.label_idx IS NULL THEN raise_error(concat('label not in vocabulary: ', "
                           "coalesce(b.label, 'NULL'))) ELSE v.label_idx END",
                  "keep": f"CAST(coalesce(v.label_idx, {k}) AS INT)",
                  "skip": "v.label_idx"}[handle_unseen]
        val_join = "JOIN" if handle_unseen == "skip" else "LEFT JOIN"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.silver AS "
                  f"SELECT {cols} FROM {database}.bronze b")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.silver_train AS "
                  f"SELECT {cols}, v.label_idx FROM {database}.bronze b "
                  f"JOIN {database}.vocab v ON b.label = v.label WHERE b.split = 'train'")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.silver_val AS "
                  f"SELECT {cols}, CAST({unseen} AS INT) AS label_idx FROM {database}.bronze b "
                  f"{val_join} {database}.vocab v ON b.label = v.label WHERE b.split = 'val'")
    return PreparedTables(spark.table(f"{database}.silver_train"), spark.table(f"{database}.silver_val"),
                          spark.table(f"{database}.vocab"), spark.table(f"{database}.vocab").count())


def train_on_images(spark: SparkSession, image_dir: str, database: str,
                    config: TR.TrainConfig | None = None, glob: str = "*.jpg",
                    height: int = 224, width: int = 224, grid: int = 4,
                    prepared: PreparedTables | None = None):
    """Entry A + B + C on image files; returns (fit, model, scored silver).

    ``prepared`` reuses an earlier ``ingest_images`` of the same database
    (re-ingesting would overwrite its tables under DataFrames already handed
    out).  The base is frozen, so every image is decoded and featurised ONCE
    into ``<database>.features``; training, validation and scoring rows join
    it by normalised path."""
    from flowline.operators import features as FE
    from flowline.sources import files as FS
    from flowline.sources import tables as TB

    t = prepared or ingest_images(spark, image_dir, database, glob=glob)
    imgs = FS.image_files(spark, image_dir, glob=glob, recursive=True)
    TB.save_table(FE.featurise(imgs, height, width, grid, keep=("path",)), f"{database}.features")
    feats = spark.table(f"{database}.features")
    key = F.xxhash64("path").alias("row_id")
    tr = FS.with_decoded(t.train.select("path", "label_idx"), feats).select(key, "features", "label_idx")
    va = FS.with_decoded(t.val.select("path", "label_idx"), feats).select(key, "features", "label_idx")
    fit = TR.fit(tr, va, t.num_classes, config or TR.TrainConfig(epochs=3, batch_size=8, workers=2))
    model = model_from_fit(fit, t.vocab, {"img_height": height, "img_width": width, "grid": grid})
    silver = spark.table(f"{database}.silver").select("path", "label")
    scored = score(FS.with_decoded(silver, feats), model)
    return fit, model, scored.select("path", "label", "prediction")


# ---------------------------------------------------------------- Entry B with tracking, Entry D
@dataclass
class DataConfig:
    """Where the training inputs live."""
    train_table: str
    validation_table: str
    key_col: str = "row_id"
    feature_col: str = "features"
    label_col: str = "label_idx"


def train_from_tables(spark: SparkSession, data: DataConfig, config: TR.TrainConfig, store,
                      vocab: DataFrame, preprocess: dict | None = None, run_name: str = "fit",
                      parent_run_id: str | None = None, checkpoint_path: str | None = None):
    """Read train/validation tables, fit, evaluate on the whole validation
    table, and record everything in the run store: parameters, the
    preprocessing config, per-epoch metrics, ``val_``-prefixed final
    metrics and the packaged model.  A run that raises ends as FAILED; with a
    ``checkpoint_path`` a later call goes on from its last epoch.  Returns
    (run_id, model, fit)."""
    cols = [data.key_col, data.feature_col, data.label_col]
    train = spark.table(data.train_table).select(*cols)
    val = spark.table(data.validation_table).select(*cols)
    k = vocab.count()
    with store.run(run_name, parent_run_id) as run_id:
        store.log_params(run_id, {**config.params(), "preprocess": json.dumps(preprocess or {}, sort_keys=True)})
        fit = fit_with_checkpoints(spark, train, val, k, config, checkpoint_path, key_col=data.key_col,
                                   feature_col=data.feature_col, label_col=data.label_col)
        store.log_history(run_id, fit.history)
        final = TR.evaluate(val, fit.weights, fit.bias, data.feature_col, data.label_col, data.key_col)
        store.log_metrics(run_id, {f"val_{m}": final[m] for m in ("loss", "accuracy")}, step=len(fit.history))
        model = model_from_fit(fit, vocab, preprocess)
        store.log_model(run_id, model)
    return run_id, model, fit


def fit_with_checkpoints(spark: SparkSession, train: DataFrame, val: DataFrame | None, num_classes: int,
                         config: TR.TrainConfig, path: str | None, run_id: str = "fit", **kw):
    """``TR.fit`` that stores its whole state after every epoch under ``path``
    and goes on from the newest one found there."""
    from flowline.sources import tables as TB

    if path is None:
        return TR.fit(train, val, num_classes, config, **kw)
    last = TB.latest_state(spark, path, run_id)

    def save(epoch, W, histories, states):
        TB.save_state(spark, path, run_id, epoch, states[0])

    return TR.fit(train, val, num_classes, config, on_epoch=save, start_epoch=last[0] + 1 if last else 0,
                  resume=[last[1]] if last else None, **kw)


def tune_register_promote(spark: SparkSession, train: DataFrame, val: DataFrame, vocab: DataFrame,
                          store, model_name: str, space: dict, base: TR.TrainConfig,
                          max_evals: int = 8, parallelism: int = 4, metric: str = "val_accuracy"):
    """Search (trials fused per round, each trial a child run), log the best
    parameters on the parent run, rank the children by ``metric``, register
    the top run's model and move it to Production.  Returns
    (best_run_id, version, model loaded back by stage)."""
    from flowline.operators import search as S

    k = vocab.count()
    names = list(space)
    with store.run("search") as parent:
        objective = S.fused_fit_objective(
            train, val, k, base, metric, store, parent,
            on_fit=lambda rid, fit: store.log_model(rid, model_from_fit(fit, vocab)))
        with objective.cache:
            res = S.run_search(spark, objective, space, max_evals=max_evals, parallelism=parallelism)
        if not res.best:
            raise ValueError("no trial succeeded")
        store.log_params(parent, {n: res.best[n] for n in names})          # values, not indexes
    ranked = store.search_runs(parent, metric, param_keys=names, metric_keys=[metric])
    best_run = ranked.filter("status = 'FINISHED'").select("run_id").first().run_id    # top-1 after ordering
    version = store.register_model(model_name, best_run)
    store.transition_stage(model_name, version, "Production")
    return best_run, version, store.load_by_stage(model_name, "production")


def score_images(spark: SparkSession, image_dir: str, model: PackagedModel, glob: str = "*.jpg",
                 batch_size: int = 128) -> DataFrame:
    """Entry C on files: decode in the JVM, featurise with the model's own
    stored preprocessing config (so training and serving share one
    preprocess), predict in Arrow batches.  Returns (path, label, prediction)
    where ``label`` is the parent folder."""
    from flowline.operators import features as FE
    from flowline.sources import files as FS

    cfg = model.preprocess or {}
    imgs = FS.image_files(spark, image_dir, glob=glob, recursive=True)
    feats = FE.featurise(imgs, int(cfg.get("img_height", 224)), int(cfg.get("img_width", 224)),
                         int(cfg.get("grid", 4)), keep=("path",))
    out = score(feats, model, "features", "prediction", batch_size=batch_size)
    from flowline.functions.columns import label_from_path
    return out.select("path", label_from_path("path").alias("label"), "prediction")
