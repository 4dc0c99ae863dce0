import threading
import time

import pytest

from flowline.operators import parzen as PZ
from flowline.operators import search as S
from flowline.operators import trials as TS

SPACE = {"optimizer": S.choice("Adadelta", "Adam"), "learning_rate": S.loguniform(-5, 0), "dropout": S.uniform(0.1, 0.9)}


def loss_of(point):
    return (point["dropout"] - 0.3) ** 2 + (0.1 if point["optimizer"] == "Adam" else 0.0)


def test_twenty_trials_replay_and_wait_for_none(spark):
    """One slow trial and one that fails: the others go on, and the log gives
    the same points again."""
    started, lock = [], threading.Lock()
    slow = {}

    def objective(point):
        with lock:
            number = len(started)
            started.append(time.time())
        spark.range(10).count()                              # a job of this trial's own
        if number == 5:
            slow["from"] = time.time()
            time.sleep(8)
            slow["to"] = time.time()
        if number == 7:
            return None, "fail", "can't be trained"
        return loss_of(point), "ok", None

    proposer = TS.Proposer(SPACE, n_startup=4)
    found = TS.run_trials(spark, objective, proposer, max_evals=20, parallelism=4)
    rows = found.trials.orderBy("trial_id").collect()
    assert [r.trial_id for r in rows] == list(range(20))
    assert [r.status for r in rows].count("fail") == 1 and next(r for r in rows if r.status == "fail").error == "can't be trained"
    assert sum(slow["from"] < t < slow["to"] for t in started) >= 3
    log = found.log.orderBy("trial_id").collect()
    assert all(len(r.running) < 4 and len(r.running) + len(r.finished) == r.trial_id for r in log)
    assert any(r.running for r in log)
    again = TS.replay(spark, found.log, found.trials, proposer)
    assert again == [{n: r[n] for n in SPACE} for r in rows]
    assert found.best["loss"] == min(r.loss for r in rows if r.loss is not None)


def test_cluster_errors_are_raised(spark):
    def objective(point):
        raise RuntimeError("executor gone")

    with pytest.raises(RuntimeError, match="executor gone"):
        TS.run_trials(spark, objective, TS.Proposer(SPACE), max_evals=6, parallelism=2)
    with pytest.raises(ValueError):
        TS.run_trials(spark, objective, TS.Proposer(SPACE), max_evals=0)


def history(spark, rows):
    return spark.createDataFrame(rows, "trial_id long, optimizer string, learning_rate double, dropout double, "
                                       "loss double, status string")


def test_proposals_learn(spark):
    """Draws gather where the good trials are; a running trial pushes away."""
    rows = [(k, "Adam" if k < 5 else "Adadelta", 0.05, 0.25 + 0.01 * k if k < 5 else 0.5 + 0.02 * k, float(k), "ok")
            for k in range(20)]
    model = PZ.parzen_model(history(spark, rows), SPACE)
    drawn = PZ.draw(spark.range(2000), "id", model, SPACE).collect()
    assert sum(0.15 < r.dropout < 0.4 for r in drawn) > 0.6 * len(drawn)
    assert sum(r.optimizer == "Adam" for r in drawn) > 0.75 * len(drawn)
    assert all(0.1 <= r.dropout <= 0.9 and r.learning_rate <= 1 for r in drawn)

    at = spark.createDataFrame([("Adam", 0.05, 0.27)], "optimizer string, learning_rate double, dropout double")
    alone = PZ.score(at, model, SPACE).first().score
    running = [(50 + k, "Adam", 0.05, 0.27, None, "running") for k in range(3)]
    pushed = PZ.score(at, PZ.parzen_model(history(spark, rows + running), SPACE), SPACE).first().score
    assert pushed < alone


def test_densities_are_densities(spark):
    rows = [(k, "Adam", 0.02 * (k + 1), 0.1 + 0.08 * k, float(k), "ok") for k in range(9)]
    model = PZ.parzen_model(history(spark, rows), SPACE)
    for side in PZ.SIDES:
        k = model.first()[f"{side}_dropout"]
        assert len({round(x.scale, 9) for x in k}) > 1          # bandwidths differ
        xs = spark.range(4000).selectExpr("(id + 0.5) / 4000 AS x").withColumn(
            "k", model.select(f"{side}_dropout").scalar())
        area = xs.selectExpr(PZ.density("k", "x") + " AS p").agg({"p": "avg"}).first()[0]
        assert abs(area - 1) < 1e-4


def test_no_job_while_a_plan_is_built(spark):
    rows = [(k, "Adam", 0.02, 0.5, float(k), "ok") for k in range(5)]
    trials = history(spark, rows)
    sc = spark.sparkContext
    sc.setJobGroup("building", "")
    try:
        plan = PZ.propose(spark, trials, SPACE, 3)
        S.tpe_scores(S.sample_points(spark, SPACE, 4), trials, SPACE)
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
        assert plan.count() == 3
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("rows", [[], [(0, "Adam", 0.1, 0.5, None, "fail")], [(0, "Adam", 0.1, 0.5, 1.0, "ok")],
                                  [(k, "Adam", 0.1, 0.5, 1.0, "ok") for k in range(4)]])
def test_short_and_tied_histories(spark, rows):
    points = PZ.propose(spark, history(spark, rows), SPACE, 2).collect()
    assert [r.point_id for r in sorted(points)] == [0, 1]
    assert all(0.1 <= r.dropout <= 0.9 and r.optimizer in ("Adam", "Adadelta") for r in points)
