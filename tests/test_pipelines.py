import numpy as np
from pyspark.sql import functions as F

from flowline.operators import runs as R
from flowline.operators import search as S
from flowline.operators import trainer as TR
from flowline.plans import pipelines as P

SF = "/root/testdata/sf0.001"


def test_train_from_tables_logs_run_and_model(spark, tmp_dir):
    t = P.prepare_tables(P.embeddings_silver(spark, SF), "row_id")
    from flowline.sources.tables import save_table
    save_table(t.train, "flowline_t_train", path=f"{tmp_dir}/t_train")
    save_table(t.val, "flowline_t_val", path=f"{tmp_dir}/t_val")
    store = R.RunStore(spark, f"{tmp_dir}/runs")
    cfg = TR.TrainConfig(epochs=2, batch_size=32, workers=2, learning_rate=1e-2)
    rid, model, fit = P.train_from_tables(spark, P.DataConfig("flowline_t_train", "flowline_t_val"),
                                          cfg, store, t.vocab, {"img_height": 224, "img_width": 224})
    wide = R.wide_runs(store.table("runs"), store.table("run_params"), store.table("run_metrics"),
                       ["batch_size", "preprocess"], ["val_loss", "val_accuracy"]).first()
    assert wide.run_id == rid and wide.batch_size == "32" and '"img_height": 224' in wide.preprocess
    assert abs(wide.val_loss - TR.evaluate(t.val, fit.weights, fit.bias)["loss"]) < 1e-12
    back = store.load_model(rid)
    assert np.allclose(back.weights, model.weights) and back.classes == model.classes


def test_tune_register_promote(spark, tmp_dir):
    t = P.prepare_tables(P.embeddings_silver(spark, SF), "row_id")
    store = R.RunStore(spark, f"{tmp_dir}/runs")
    space = {"optimizer": S.choice("Adadelta", "Adam"), "learning_rate": S.loguniform(-5, 0),
             "dropout": S.uniform(0.1, 0.9)}
    base = TR.TrainConfig(epochs=1, batch_size=64, workers=2)
    best, version, model = P.tune_register_promote(spark, t.train, t.val, t.vocab, store, "clf",
                                                   space, base, max_evals=4, parallelism=2)
    assert version == 1
    children = store.table("runs").filter(F.col("parent_run_id").isNotNull()).count()
    assert children == 4
    top = store.search_runs(store.table("runs").filter(F.col("parent_run_id").isNull()).first().run_id,
                            "val_accuracy").first()
    assert top.run_id == best
    assert store.run_for_stage("clf", "Production") == best
    assert len(model.classes) == 10
    params = {r.key: r.value for r in store.table("run_params")
              .filter(F.col("run_id") == store.table("runs").filter(F.col("parent_run_id").isNull())
                      .first().run_id).collect()}
    assert params["optimizer"] in ("Adadelta", "Adam")                 # a value, not an index
