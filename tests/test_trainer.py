from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowline.operators import trainer as TR

SF = "/root/testdata/sf0.001"


def _emb(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"),
                    F.col("label").alias("label_idx"))


def _numpy_data(df):
    rows = df.orderBy("row_id").collect()
    X = np.array([r.features for r in rows], dtype=np.float64)
    y = np.array([r.label_idx for r in rows])
    return X, y


def _loss(X, y, W, b):
    z = X @ W + b
    m = z.max(axis=1, keepdims=True)
    lse = m[:, 0] + np.log(np.exp(z - m).sum(axis=1))
    return float((lse - z[np.arange(len(y)), y]).mean())


def test_gradient_matches_finite_differences(spark):
    df = _emb(spark)
    X, y = _numpy_data(df)
    rng = np.random.default_rng(0)
    W = rng.normal(0, 0.1, size=(64, 10))
    b = rng.normal(0, 0.1, size=10)
    g, loss, n = TR.gradient(df, W, b)
    assert n == len(y)
    assert abs(loss - _loss(X, y, W, b)) < 1e-9
    eps = 1e-6
    for (i, k) in [(0, 0), (5, 3), (63, 9), (64, 2)]:
        Wp, bp = W.copy(), b.copy()
        Wm, bm = W.copy(), b.copy()
        if i < 64:
            Wp[i, k] += eps
            Wm[i, k] -= eps
        else:
            bp[k] += eps
            bm[k] -= eps
        fd = (_loss(X, y, Wp, bp) - _loss(X, y, Wm, bm)) / (2 * eps)
        assert abs(fd - g[i, k]) < 1e-6


def test_gradient_independent_of_partitioning(spark):
    df = _emb(spark)
    W = np.full((64, 10), 0.01)
    ref = TR.gradient(df.repartition(1), W)[0]
    for n in (2, 7):
        g = TR.gradient(df.repartition(n), W)[0]
        assert np.max(np.abs(g - ref)) < 1e-9


def test_dropout_mask_deterministic():
    keys = np.arange(1000)
    a = TR.dropout_keep(keys, 64, 0.5, 42, 0, 1, 2)
    b = TR.dropout_keep(keys[::-1], 64, 0.5, 42, 0, 1, 2)[::-1]
    assert (a == b).all()
    assert abs(a.mean() - 0.5) < 0.02
    c = TR.dropout_keep(keys, 64, 0.5, 42, 0, 1, 3)
    assert (a != c).any()


def test_adam_matches_formula():
    w = np.array([[1.0, -1.0]])
    g = np.array([[0.5, -0.25]])
    opt = TR.Optimizer("adam", w.shape)
    w1 = opt.update(w, g, 0.1)
    # first Adam step moves each weight by lr * sign(g) (up to epsilon)
    assert np.allclose(w1, w - 0.1 * np.sign(g), atol=1e-6)
    ad = TR.Optimizer("adadelta", w.shape)
    assert np.all(np.sign(w - ad.update(w, g, 1.0)) == np.sign(g))


def test_early_stop_rule():
    assert TR.early_stop_epoch([1.0, 0.9, 0.8, 0.7], patience=2) is None          # improving
    assert TR.early_stop_epoch([1.0, 1.0, 1.0, 1.0], patience=3) == 3             # flat
    # late gains smaller than min_delta do not reset the counter
    assert TR.early_stop_epoch([1.0, 0.995, 0.991, 0.992], patience=3, min_delta=0.01) == 3
    assert TR.early_stop_epoch([1.0, 0.995, 0.98, 0.97], patience=3, min_delta=0.01) is None


def test_plateau_reduces_lr():
    p = TR.Plateau(patience=2, factor=0.5)
    for v in (1.0, 1.0, 1.0):              # best 1.0, then two epochs without gain
        p.observe(v)
    assert p.scale == 0.5 and p.apply(0.1) == 0.05
    for v in (1.0, 1.0):                   # two more: reduced again, not compounded twice
        p.observe(v)
    assert p.scale == 0.25
    p.observe(0.5)                         # an improvement resets the counter
    p.observe(0.5)
    assert p.scale == 0.25
    q = TR.Plateau(patience=1, factor=0.1, min_lr=1e-3)
    for _ in range(4):                     # best, then three reductions: 0.1 * 1e-3 < floor
        q.observe(1.0)
    assert q.apply(0.1) == 1e-3            # floor


def test_full_batch_fit_approaches_convex_optimum(spark):
    df = _emb(spark)
    X, y = _numpy_data(df)
    ref = TR.fit_full_batch(df, 10, max_iter=200, reg=0.0)
    ref_loss = _loss(X, y, ref.weights, ref.bias)
    cfg = TR.TrainConfig(epochs=40, batch_size=len(y), workers=1, learning_rate=0.05,
                         optimizer="adam", dropout=0.0, scale_lr=False)
    fit = TR.fit(df, None, 10, cfg)
    ours = _loss(X, y, fit.weights, fit.bias)
    start = _loss(X, y, TR.glorot(64, 10, 42)[:64], np.zeros(10))
    assert ours < start
    assert ours - ref_loss < 0.25 * (start - ref_loss)


def test_fused_trials_equal_separate_fits(spark):
    df = _emb(spark)
    a = TR.TrainConfig(epochs=2, batch_size=64, workers=2, learning_rate=0.01, dropout=0.3)
    b = replace(a, learning_rate=0.003, optimizer="adadelta", dropout=0.0)
    fused = TR.fit_many(df, df, 10, [a, b])
    single = TR.fit(df, df, 10, b)
    # trial 1 of the fused pass uses trial index 1 for its masks; with no
    # dropout the two are the same computation
    assert np.allclose(fused[1].weights, single.weights, atol=1e-10)
    assert fused[0].history[-1]["val_loss"] > 0


def test_sharded_step_is_one_step_over_the_rows_it_reads(spark):
    """Two shards, one SGD step: the update is that of all rows read, each as
    often as the endless feed passes it (the batch is larger than a shard)."""
    df = _emb(spark)
    cfg = TR.TrainConfig(epochs=1, batch_size=500, workers=2, dropout=0.0, scale_lr=False,
                         optimizer="sgd", learning_rate=0.5)
    fit = TR.fit(df, None, 10, cfg)
    snap = TR.feature_snapshot(df, "row_id", "features", "label_idx", 2)
    rows = TR.feed_step(snap, 0, 500).select("features", "label_idx", "visits").collect()
    snap.release()
    times = np.array([r.visits for r in rows])
    X = np.repeat(np.array([r.features for r in rows], dtype=np.float64), times, axis=0)
    y = np.repeat([r.label_idx for r in rows], times)
    assert fit.steps_per_epoch == 1 and len(y) == 1000
    W = TR.glorot(64, 10, 42)
    z = X @ W[:64] + W[64]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    assert np.allclose(fit.weights, W[:64] - 0.5 * X.T @ p / len(y), atol=1e-9)


def test_resumed_fit_equals_straight_fit(spark, tmp_dir):
    """Adam, plateau and dropout: the stored state is the whole state."""
    from flowline.plans.pipelines import fit_with_checkpoints
    df = _emb(spark)
    cfg = TR.TrainConfig(epochs=3, batch_size=128, workers=2, learning_rate=0.01, dropout=0.2, plateau_patience=1)
    straight = TR.fit(df, df, 10, cfg)
    path = f"{tmp_dir}/state"
    fit_with_checkpoints(spark, df, df, 10, replace(cfg, epochs=2), path)
    resumed = fit_with_checkpoints(spark, df, df, 10, cfg, path)
    assert np.allclose(resumed.weights, straight.weights, atol=1e-12)
    assert [h["epoch"] for h in resumed.history] == [0, 1, 2]
    assert resumed.history[-1]["val_loss"] == pytest.approx(straight.history[-1]["val_loss"], abs=1e-12)


def test_all_reduce_is_the_same_for_any_partitioning(spark, monkeypatch):
    df = _emb(spark)
    W = np.random.default_rng(3).normal(0, 0.1, size=(2, 65, 10))
    drops = np.array([0.0, 0.3])
    one = TR.all_reduce(df.coalesce(1), W, drops, 7, 1, 2, True)
    monkeypatch.setattr(TR, "FAN_IN", 4)                       # 40 partials, at most 4 per merge
    many = TR.all_reduce(df.repartition(40), W, drops, 7, 1, 2, True)
    assert one[3:] == many[3:] == (500, 500)
    for a, b in zip(one[:3], many[:3]):
        assert np.allclose(a, b, rtol=0, atol=1e-9)


def test_unknown_class_is_a_counted_miss(spark):
    df = _emb(spark)
    kept = df.withColumn("label_idx", F.when(F.col("label_idx") == 9, 99).otherwise(F.col("label_idx")))
    n = df.filter("label_idx = 9").count()
    fit = TR.fit(kept, kept, 10, TR.TrainConfig(epochs=1, batch_size=64, workers=2))
    assert fit.final["val_unknown_rows"] == n
    ev = TR.evaluate(kept, fit.weights, fit.bias)
    assert ev["unknown"] == n and ev["n"] == 500 and ev["accuracy"] <= (500 - n) / 500


def test_a_trial_is_the_same_in_any_company(spark):
    df = _emb(spark)
    a = TR.TrainConfig(epochs=1, batch_size=128, workers=2, learning_rate=0.01, dropout=0.4)
    b = replace(a, learning_rate=0.003, dropout=0.2, seed=7)
    alone, second = TR.fit(df, None, 10, b), TR.fit_many(df, None, 10, [a, b])[1]
    assert np.allclose(alone.weights, second.weights, atol=1e-12)


def test_every_row_is_fed(spark):
    """Steps of the whole fit walk each shard's endless feed without a cut."""
    df = _emb(spark)
    snap = TR.feature_snapshot(df, "row_id", "features", "label_idx", 3)
    seen: dict = {}
    for step in range(12):
        rows = TR.feed_step(snap, step * 20, step * 20 + 20).select("row_id", "shard", "visits").collect()
        per_shard: dict = {}
        for r in rows:
            seen[r.row_id] = seen.get(r.row_id, 0) + r.visits
            per_shard[r.shard] = per_shard.get(r.shard, 0) + r.visits
        assert set(per_shard.values()) == {20}
    assert len(seen) == 500 and max(seen.values()) - min(seen.values()) <= 1
    huge = TR.feed_step(snap, 7, 7 + 1000).agg(F.sum("visits")).first()[0]       # a batch above the shard
    assert huge == 3000
    snap.release()


def test_finished_trial_leaves_fused_pass_without_changing_others(spark):
    df = _emb(spark)
    a_short = TR.TrainConfig(epochs=1, batch_size=128, workers=2, learning_rate=0.01, dropout=0.4)
    b = replace(a_short, epochs=3, learning_rate=0.003, dropout=0.2)
    short = TR.fit_many(df, df, 10, [a_short, b])
    full = TR.fit_many(df, df, 10, [replace(a_short, epochs=3), b])
    assert len(short[0].history) == 1 and len(short[1].history) == 3
    # b's masks are keyed by its trial id, so a's early exit changes nothing for b
    assert np.allclose(short[1].weights, full[1].weights, atol=1e-12)
    assert short[1].history[-1]["val_loss"] == full[1].history[-1]["val_loss"]


def test_block_size_of_the_feed_does_not_change_the_fit(spark, monkeypatch):
    df = _emb(spark)
    cfg = TR.TrainConfig(epochs=2, batch_size=32, workers=2, learning_rate=0.01, dropout=0.3)
    plain = TR.fit(df, None, 10, cfg)
    monkeypatch.setattr(TR, "FEED_BLOCK", 50)
    snap = TR.feature_snapshot(df, "row_id", "features", "label_idx", 2)
    plan = TR.feed_step(snap, 128, 160)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "pos_block" in plan
    snap.release()
    blocked = TR.fit(df, None, 10, cfg)
    assert np.allclose(plain.weights, blocked.weights, atol=1e-12)


def test_empty_training_table_is_a_clear_error(spark):
    df = _emb(spark).limit(0)
    with pytest.raises(ValueError, match="no training rows"):
        TR.fit(df, None, 10, TR.TrainConfig(epochs=1))


def test_one_local_step_is_the_synchronous_pass(spark):
    """H = 1 through the local path gives the all-reduce's sums, masks included."""
    df = _emb(spark)
    rng = np.random.default_rng(3)
    W, drops = rng.normal(size=(2, 65, 10)), np.array([0.0, 0.3])
    with TR.FeedCache(df, None) as cache:
        snap = cache.train(3)
        for at in (0, 40, 100_000):                          # also where the feed wraps around
            plain = TR.all_reduce(TR.feed_step(snap, at, at + 40), W, drops, [5, 6], 1, 2, True)
            local = TR.local_steps(snap, at, 40, 1, W, np.array([0.1, 9.0]), drops, [5, 6], 1, 2)
            for x, y in zip(plain, local):
                assert np.allclose(x, y, rtol=0, atol=1e-9)


def test_local_steps_by_hand(spark):
    """Three local steps of two shards, then the average, against numpy."""
    df, rate, H = _emb(spark), 0.3, 3
    with TR.FeedCache(df, None) as cache:
        snap = cache.train(2)
        rows = snap.df.orderBy("shard", "pos").collect()
        B = 20
        ends = []
        for shard in (0, 1):
            mine = [r for r in rows if r.shard == shard]
            w = np.zeros((65, 10))
            for h in range(H):
                part = [mine[(7 + h * B + i) % len(mine)] for i in range(B)]
                X = np.array([[*r.features, 1.0] for r in part], np.float64)
                z = X @ w
                p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
                p[np.arange(B), [r.label_idx for r in part]] -= 1
                w = w - rate * X.T @ p / B
            ends.append(w)
        g, _, _, n, known = TR.local_steps(snap, 7, B, H, np.zeros((1, 65, 10)), np.array([rate]), np.zeros(1), [0], 0, 0)
    assert n == known == 2 * H * B
    assert np.allclose(-rate * H * g[0] / known, np.mean(ends, axis=0), atol=1e-10)


def test_local_steps_need_fewer_jobs(spark, monkeypatch):
    passes = []
    real = TR.local_steps
    monkeypatch.setattr(TR, "local_steps", lambda *a, **k: passes.append(a[3]) or real(*a, **k))
    cfg = TR.TrainConfig(epochs=2, batch_size=32, workers=2, learning_rate=0.05, optimizer="sgd", dropout=0.0, local_steps=3)
    df = _emb(spark)
    fit = TR.fit(df, df, 10, cfg)
    steps = fit.steps_per_epoch
    assert steps > 3 and sum(passes) == 2 * steps and len(passes) == 2 * -(-steps // 3)
    assert fit.history[1]["loss"] < fit.history[0]["loss"]
    assert all(h["rows"] == steps * 64 for h in fit.history)
    with pytest.raises(ValueError):
        TR.fit(df, None, 10, replace(cfg, local_steps=0))
    with pytest.raises(ValueError):
        TR.fit_many(df, None, 10, [cfg, replace(cfg, local_steps=2)])


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_small_steps_are_made_in_one_job_and_the_same_fit(spark, monkeypatch):
    """Smaller batches make more steps, not more jobs; the fit is that of a job
    a step, with fused trials, masks, warm-up, rows read twice and unseen classes."""
    df = _emb(spark)
    one = TR.TrainConfig(epochs=2, batch_size=24, workers=2, dropout=0.3, warmup_epochs=1, plateau_patience=1)
    configs = [one, replace(one, optimizer="adadelta", learning_rate=0.5), replace(one, optimizer="sgd", epochs=1)]
    many, jobs = _jobs(spark, "few", lambda: TR.fit_many(df, df, 8, configs))
    finer, more = _jobs(spark, "fine", lambda: TR.fit_many(df, df, 8, [replace(c, batch_size=4) for c in configs]))
    assert finer[0].steps_per_epoch >= 5 * many[0].steps_per_epoch and more == jobs
    with monkeypatch.context() as m:
        m.setattr(TR, "RUN_VALUES", 24 * 2 * 64 * 2)          # two steps a job
        two = TR.fit_many(df, df, 8, configs)
    monkeypatch.setattr(TR, "STEP_VALUES", 1)
    for a, b in [*zip(many, two), *zip(many, TR.fit_many(df, df, 8, configs))]:
        assert np.allclose(a.weights, b.weights, rtol=1e-9, atol=1e-12) and len(a.history) == len(b.history)
        for x, y in zip(a.history, b.history):
            assert x.keys() == y.keys() and all(x[k] == pytest.approx(y[k], rel=1e-9) for k in x)


def test_a_batch_larger_than_the_shards_repeats_rows(spark, monkeypatch):
    few = _emb(spark).filter("row_id < 7")
    cfg = TR.TrainConfig(epochs=2, batch_size=16, workers=2, dropout=0.0)
    fit = TR.fit(few, None, 10, cfg)
    monkeypatch.setattr(TR, "STEP_VALUES", 1)
    plain = TR.fit(few, None, 10, cfg)
    assert np.allclose(fit.weights, plain.weights, rtol=1e-9, atol=1e-12)
    assert [h["rows"] for h in fit.history] == [h["rows"] for h in plain.history]
