import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowline.operators import runs as R


def test_run_store_search_register_promote(spark, tmp_dir):
    st = R.RunStore(spark, f"{tmp_dir}/runs")
    parent = st.start_run("search")
    kids = []
    for i, acc in enumerate([0.5, 0.9, None, 0.9]):
        rid = st.start_run(f"trial_{i}", parent)
        st.log_params(rid, {"lr": 0.01 * (i + 1)})
        st.log_history(rid, [{"epoch": 0, "val_accuracy": 0.1}] +
                       ([{"epoch": 1, "val_accuracy": acc}] if acc is not None else []))
        st.end_run(rid)
        kids.append(rid)
    st.end_run(parent)
    res = st.search_runs(parent, "val_accuracy", param_keys=["lr"]).collect()
    assert len(res) == 4
    top = res[0]
    assert top.val_accuracy == 0.9 and top.run_id == min(kids[1], kids[3])   # tie -> run id
    assert res[-1].val_accuracy == 0.1                                       # last logged value
    with pytest.raises(ValueError):
        st.search_runs(parent, "accuracy")

    v1 = st.register_model("m", kids[1])
    v2 = st.register_model("m", kids[3])
    assert (v1, v2) == (1, 2)
    st.transition_stage("m", 1, "Production")
    st.transition_stage("m", 1, "Archived")       # demote
    st.transition_stage("m", 2, "Production")
    st.transition_stage("m", 1, "Production")     # promote again
    assert st.run_for_stage("m", "production") == kids[3]     # highest version in stage
    st.transition_stage("m", 2, "Archived")
    assert st.run_for_stage("m", "PRODUCTION") == kids[1]
    assert st.run_for_stage("m", "staging") is None


def test_rank_and_top_with_hot_parent(spark):
    rows = [(i, "hot" if i % 3 else f"p{i % 7}", float((i * 37) % 11) if i % 5 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "run_id long, parent_run_id string, m double")
    ranked = {r.run_id: r.rank for r in R.rank_runs(df, "m").collect()}
    w = Window.partitionBy("parent_run_id").orderBy(F.col("m").desc_nulls_last(), "run_id")
    expect = {r.run_id: r.rk for r in df.select("run_id", F.row_number().over(w).alias("rk")).collect()}
    assert ranked == expect
    top = {r.parent_run_id: r.run_id for r in R.top_runs(df, "m").collect()}
    assert top == {pid: rid for rid, rk in expect.items() if rk == 1
                   for pid in [next(r[1] for r in rows if r[0] == rid)]}


def test_child_runs_and_wide(spark):
    runs = spark.createDataFrame([("a", None, "ok"), ("b", "a", "ok"), ("c", "a", "ok"), ("d", "x", "ok")],
                                 "run_id string, parent_run_id string, status string")
    kids = sorted(r.run_id for r in R.child_runs(runs, cols=["status"]).collect())
    assert kids == ["b", "c"]
    params = spark.createDataFrame([("b", "lr", "0.1")], "run_id string, key string, value string")
    mets = spark.createDataFrame([("b", "loss", 0, 2.0), ("b", "loss", 3, 1.0)],
                                 "run_id string, key string, step long, value double")
    w = {r.run_id: r for r in R.wide_runs(runs, params, mets, ["lr"], ["loss"]).collect()}
    assert w["b"].lr == "0.1" and w["b"].loss == 1.0 and w["a"].loss is None


def test_loss_is_ranked_ascending(spark, tmp_dir):
    st = R.RunStore(spark, f"{tmp_dir}/by_loss")
    parent = st.start_run("p")
    for v in (0.5, 0.1, 0.9):
        rid = st.start_run(f"r{v}", parent)
        st.log_metrics(rid, {"val_loss": v, "val_accuracy": v})
        st.end_run(rid)
    by = lambda m, **kw: [r[m] for r in st.search_runs(parent, m, **kw).collect()]
    assert by("val_loss") == [0.1, 0.5, 0.9]
    assert by("val_accuracy") == [0.9, 0.5, 0.1]
    assert by("val_loss", ascending=False) == [0.9, 0.5, 0.1]


def test_a_run_is_there_while_it_runs_and_fails_visibly(spark, tmp_dir):
    st = R.RunStore(spark, f"{tmp_dir}/status")
    rid = st.start_run("slow")
    assert [r.status for r in st.table("runs").collect()] == ["RUNNING"]
    st.end_run(rid)
    with pytest.raises(ValueError):
        with st.run("bad"):
            raise ValueError("no")
    assert sorted((r.name, r.status) for r in st.table("runs").collect()) == [("bad", "FAILED"), ("slow", "FINISHED")]


def test_two_writers_at_once_get_two_versions(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    stores = [R.RunStore(spark, f"{tmp_dir}/runs") for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: stores[k % 4].register_model("m/ö 1", f"r{k}"), range(12)))
    assert sorted(got) == list(range(1, 13))
    rows = {r.run_id: r.version for r in stores[0].table("registrations").collect()}
    assert rows == {f"r{k}": v for k, v in enumerate(got)}
    assert stores[1].register_model("other", "x") == 1


def test_an_older_registration_moves_no_number(spark, tmp_dir):
    import datetime as dt
    st = R.RunStore(spark, f"{tmp_dir}/runs")
    assert st.register_models([("m", "r1"), ("m", "r2")]) == [1, 2]
    st.transition_stage("m", 2, "Production")
    assert st.register_model("m", "late", dt.datetime(2001, 1, 1)) == 3
    assert st.run_for_stage("m") == "r2"
    assert {r.run_id: r.version for r in st.table("registrations").collect()} == {"r1": 1, "r2": 2, "late": 3}


def test_a_claimed_number_without_a_row_is_a_gap(spark, tmp_dir):
    st = R.RunStore(spark, f"{tmp_dir}/runs")
    st.register_model("m", "r1")
    assert R.claim_next(spark, f"{st.root}/versions/m") == 2          # a writer that was lost
    assert st.register_model("m", "r3") == 3


def test_conditions_and_orders(spark, tmp_dir):
    st = R.RunStore(spark, f"{tmp_dir}/runs")
    for i, (opt, acc, loss, team) in enumerate([("Adam", 0.9, 0.3, "a"), ("Adadelta", 0.95, 0.2, "b"), ("sgd", None, 0.1, "a"),
                                                ("Adam", 0.9, 0.1, "it's")]):
        with st.run(f"run{i}") as rid:
            st.log_params(rid, {"optimizer": opt, "odd key": i})
            st.set_tags(rid, {"team": team})
            st.log_metrics(rid, {"acc": 0.0, "loss": 9.0}, step=0)
            st.log_metrics(rid, {"acc": acc, "loss": loss}, step=1)

    def names(where=None, order_by=("attributes.name",)):
        return [r.name for r in st.find_runs(where, order_by).collect()]

    assert names() == ["run0", "run1", "run2", "run3"]
    assert names("metrics.acc >= 0.9 AND params.optimizer LIKE 'Ad%'") == ["run0", "run1", "run3"]
    assert names("tags.team = 'a' OR metrics.loss < 0.15") == ["run0", "run2", "run3"]
    assert names("(tags.team = 'a' OR tags.team = 'b') AND NOT metrics.loss < 0.15") == ["run0", "run1"]
    assert names("tags.team = \"it's\"") == ["run3"]
    assert names("params.`odd key` IN ('1', '2')") == ["run1", "run2"]
    assert names("tags.team <> 'metrics.loss'") == ["run0", "run1", "run2", "run3"]      # text is no key
    assert names(None, ["metrics.acc DESC", "metrics.loss ASC"]) == ["run1", "run3", "run0", "run2"]
    assert names(None, ["params.optimizer desc", "metrics.loss"]) == ["run2", "run3", "run0", "run1"]
    assert names("metrics.nothing > 1") == []
    with pytest.raises(ValueError):
        st.find_runs("attributes.nothing = 1")


def test_unknown_direction_is_warned_of(spark):
    df = spark.createDataFrame([("r1", "p", 10.0), ("r2", "p", 99.0)], "run_id string, parent_run_id string, perplexity double")
    with pytest.warns(UserWarning, match="perplexity"):
        R.top_runs(df, "perplexity")
    assert R.top_runs(df, "perplexity", ascending=True).first().run_id == "r1"


def test_an_active_run_logs_by_itself(spark, tmp_dir):
    from flowline.operators import trainer as TR
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    df = e.select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"), F.col("label").alias("label_idx"))
    st = R.RunStore(spark, f"{tmp_dir}/runs")
    cfg = TR.TrainConfig(epochs=2, batch_size=250, workers=1, dropout=0.0)
    with st.active_run("fit") as rid:
        fit = TR.fit(df, df, 10, cfg)
        TR.evaluate(df, fit.weights, fit.bias)
    TR.evaluate(df, fit.weights, fit.bias)                    # no active run: logged nowhere
    row = st.find_runs("params.epochs = '2' AND metrics.eval_n > 0", show=["metrics.val_loss"]).collect()
    assert [r.run_id for r in row] == [rid] and row[0]["metrics.val_loss"] == fit.history[-1]["val_loss"]
    assert st.table("run_metrics").filter("key = 'loss'").count() == 2
    assert st.table("run_metrics").filter("key = 'eval_n'").count() == 1
    assert (st.load_model(rid).weights == fit.weights).all()
