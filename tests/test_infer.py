import pytest
import numpy as np

from flowline.operators.infer import PackagedModel, score


def test_batch_udf_equals_numpy_and_round_trips(spark, tmp_dir):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rng = np.random.default_rng(1)
    m = PackagedModel(rng.normal(size=(64, 3)), rng.normal(size=3), ["a", "b", "c"], {"img_height": 4})
    m.save(spark, f"{tmp_dir}/model")
    loaded = PackagedModel.load(spark, f"{tmp_dir}/model")
    assert loaded.classes == ["a", "b", "c"] and loaded.preprocess == {"img_height": 4}
    assert np.allclose(loaded.weights, m.weights) and np.allclose(loaded.bias, m.bias)
    rows = score(e, loaded, "embedding", batch_size=7).select("vec_id", "embedding", "prediction").collect()
    for r in rows:
        assert r.prediction == m.classes[int(np.argmax(np.array(r.embedding) @ m.weights + m.bias))]
    idx = score(e, loaded, "embedding", output="index", limit=5, order_by=["vec_id"]).collect()
    assert len(idx) == 5 and all(isinstance(r.prediction, int) for r in idx)


def test_model_as_sql_function_by_address(spark, tmp_dir):
    from flowline.operators import infer as I
    from flowline.operators.runs import RunStore
    store = RunStore(spark, f"{tmp_dir}/runs")
    heads = {}
    for k, bias in enumerate(([0.0, 9.0], [9.0, 0.0])):
        with store.run(f"r{k}") as run:
            store.log_model(run, I.PackagedModel(np.zeros((3, 2)), np.array(bias), ["cat", "dog"]))
        heads[k] = run
        assert store.register_model("pets/all", run) == k + 1
    store.transition_stage("pets/all", 2, "Production")
    rows = spark.range(5).selectExpr("id", "array(1.0, 2.0, CAST(id AS DOUBLE)) AS x")

    def said(uri, output="label"):
        I.register_function(spark, store, uri, "said", output, batch_size=2)
        return {r.p for r in spark.sql("SELECT said(x) AS p FROM {t}", t=rows).collect()}

    assert said(f"runs:/{heads[0]}") == {"dog"} and said("models:/pets/all/1") == {"dog"}
    assert said("models:/pets/all/production") == {"cat"}
    assert said("models:/pets/all/2", "index") == {0}
    for wrong, error in (("models:/pets/all/staging", KeyError), ("models:/nobody/1", KeyError), ("pets", ValueError)):
        with pytest.raises(error):
            I.resolve(store, wrong)
