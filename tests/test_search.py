import math

from pyspark.sql import functions as F

from flowline.operators import search as S

SPACE = {"optimizer": S.choice("Adadelta", "Adam"), "learning_rate": S.loguniform(-5, 0),
         "dropout": S.uniform(0.1, 0.9)}


def test_points_in_range_and_stable(spark):
    a = S.sample_points(spark, SPACE, 200, "x").collect()
    b = S.sample_points(spark, SPACE, 200, "x").collect()
    assert a == b
    for r in a:
        assert r.optimizer in ("Adadelta", "Adam")
        assert math.exp(-5) <= r.learning_rate < 1.0
        assert 0.1 <= r.dropout < 0.9


def _trials(spark):
    rows = [(0, "Adam", 0.01, 0.5, -0.8, "ok"), (1, "Adam", 0.02, 0.4, -0.9, "ok"),
            (2, "Adadelta", 0.5, 0.2, None, "fail"), (3, "Adadelta", 0.3, 0.8, -0.9, "ok"),
            (4, "Adam", 0.001, 0.6, -0.1, "ok")]
    return spark.createDataFrame(rows, "trial_id long, optimizer string, learning_rate double, "
                                       "dropout double, loss double, status string")


def test_best_trial_excludes_failed_and_breaks_ties(spark):
    b = S.best_trial(_trials(spark), list(SPACE)).first()
    assert b.trial_id == 1 and b.loss == -0.9 and b.optimizer == "Adam"


def test_tpe_scores_match_brute_force(spark):
    t = _trials(spark)
    cands = S.sample_points(spark, SPACE, 10, "c")
    got = {r.point_id: r.score for r in S.tpe_scores(cands, t, SPACE, gamma=0.25, bw=0.2).collect()}
    ok = [r for r in t.collect() if r.status == "ok"]
    ok.sort(key=lambda r: (r.loss, r.trial_id))
    n_good = max(1, math.ceil(0.25 * len(ok)))
    good, bad = ok[:n_good], ok[n_good:]

    def unit(name, v):
        spec = SPACE[name]
        return (math.log(v) - spec[1]) / (spec[2] - spec[1]) if spec[0] == "loguniform" else \
            (v - spec[1]) / (spec[2] - spec[1])

    def dens(side, name, x):
        if SPACE[name][0] == "choice":
            return (sum(1 for r in side if r[name] == x) + 1) / (len(side) + len(SPACE[name][1]))
        k = sum(math.exp(-(unit(name, x) - unit(name, r[name])) ** 2 / (2 * 0.04)) for r in side)
        return (k / (0.2 * math.sqrt(2 * math.pi)) + 1) / (len(side) + 1)

    for c in cands.collect():
        s = sum(math.log(dens(good, n, c[n])) - math.log(dens(bad, n, c[n])) for n in SPACE)
        assert abs(s - got[c.point_id]) < 1e-9


def test_run_search_rounds(spark):
    seen = []

    def objective(points):
        seen.append(len(points))
        return [((math.log(p["learning_rate"]) + 3) ** 2 + p["dropout"], "ok") if p["optimizer"] == "Adam"
                else (None, "fail") for p in points]

    res = S.run_search(spark, objective, SPACE, max_evals=10, parallelism=4, n_startup=4)
    assert seen == [4, 4, 2]
    rows = res.trials.collect()
    assert len(rows) == 10
    oks = [r for r in rows if r.status == "ok"]
    if oks:
        assert res.best["loss"] == min(r.loss for r in oks)
    assert all(r.loss is None for r in rows if r.status == "fail")


def test_fused_objective_checkpoints_each_trial(spark, tmp_dir):
    import os
    from flowline.operators import trainer as TR
    from flowline.plans.pipelines import embeddings_silver, prepare_tables
    from flowline.sources.tables import latest_checkpoint
    t = prepare_tables(embeddings_silver(spark, "/root/testdata/sf0.001"), "row_id")
    base = TR.TrainConfig(epochs=2, batch_size=64, workers=2)
    root = f"{tmp_dir}/ckpt"
    obj = S.fused_fit_objective(t.train, t.val, t.num_classes, base, "val_loss", checkpoint_root=root)
    points = [{"learning_rate": 0.01, "dropout": 0.5, "batch_size": 64},
              {"learning_rate": 0.001, "dropout": 0.2, "batch_size": 32}]
    res = obj(points)
    obj.cache.release()
    assert all(status == "ok" for _, status, _ in res)
    names = sorted(os.listdir(root))
    assert names == sorted(S.checkpoint_name(p) for p in points)
    assert names[0].startswith("batch_size_") and "learning_rate_0.01" in " ".join(names)
    for p in points:
        epoch, w, b = latest_checkpoint(spark, f"{root}/{S.checkpoint_name(p)}", "trial")
        assert epoch == 1 and w.shape == (64, 10)


def test_run_search_with_float_and_int_choices(spark):
    space = {"dropout": S.choice(0.1, 0.5), "batch_size": S.choice(32, 64), "opt": S.choice("a", "b")}
    res = S.run_search(spark, lambda pts: [(p["dropout"] + p["batch_size"] / 100, "ok") for p in pts],
                       space, max_evals=3, parallelism=3, algo="rand")
    types = dict(res.trials.dtypes)
    assert (types["dropout"], types["batch_size"], types["opt"]) == ("double", "bigint", "string")
    assert res.best["loss"] == min(r.loss for r in res.trials.collect())


def test_one_bad_trial_fails_alone(spark):
    from flowline.operators import trainer as TR
    from flowline.plans.pipelines import embeddings_silver, prepare_tables
    t = prepare_tables(embeddings_silver(spark, "/root/testdata/sf0.001"), "row_id")
    obj = S.fused_fit_objective(t.train, t.val, t.num_classes, TR.TrainConfig(epochs=1, batch_size=64, workers=2))
    with obj.cache:
        res = obj([{"optimizer": o, "learning_rate": 0.01, "dropout": 0.2} for o in ("adam", "nosuch", "adadelta")])
    assert [r[1] for r in res] == ["ok", "fail", "ok"]
    assert res[1][0] is None and "nosuch" in res[1][2]


def test_equal_points_have_folders_of_their_own(spark, tmp_dir):
    import os
    from flowline.operators import trainer as TR
    from flowline.plans.pipelines import embeddings_silver, prepare_tables
    t = prepare_tables(embeddings_silver(spark, "/root/testdata/sf0.001"), "row_id")
    obj = S.fused_fit_objective(t.train, t.val, t.num_classes, TR.TrainConfig(epochs=1, batch_size=256, workers=2),
                                "val_loss", checkpoint_root=f"{tmp_dir}/ckpt")
    point = {"learning_rate": 0.01}
    with obj.cache:
        obj([point, point])
        obj([point])
    name = S.checkpoint_name(point)
    assert sorted(os.listdir(f"{tmp_dir}/ckpt")) == [name, f"{name}_trial_2", f"{name}_trial_3"]
    assert len({spark.read.parquet(f"{tmp_dir}/ckpt/{x}").count() for x in os.listdir(f"{tmp_dir}/ckpt")}) == 1
