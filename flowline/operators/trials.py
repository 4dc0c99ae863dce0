"""Trials that don't wait for each other.

``run_trials`` keeps at most ``parallelism`` trials running, each a thread of
the driver that submits its own Spark jobs.  As soon as one ends, the next
point is proposed from what is known then: finished trials with their losses,
and running ones, which count as bad (``parzen``), so that a proposal keeps
away from points that are being tried.

A proposal depends on its trial's number and on which trials were finished and
which were running, and on nothing else.  The log keeps both sets for every
trial; ``replay`` makes the same points again from the log and the trials'
results.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from flowline.operators.parzen import propose
from flowline.operators.search import best_trial, param_type, sample_points

Objective = Callable[[dict], tuple]


@dataclass(frozen=True)
class Proposer:
    """How points are proposed; part of the log's meaning."""
    space: dict = field(hash=False)
    algo: str = "tpe"               # "rand": never from the history
    n_startup: int = 4              # first trials at random, and while none has succeeded
    n_candidates: int = 24
    gamma: float = 0.25
    prior_weight: float = 1.0
    seed: str = "trials"

    def schema(self) -> str:
        return ("trial_id bigint, " + ", ".join(f"{n} {param_type(s)}" for n, s in self.space.items())
                + ", loss double, status string, error string")

    def point(self, spark: SparkSession, number: int, finished: list[tuple], running: list[tuple]) -> dict:
        """The point of trial ``number`` (a job of a few rows)."""
        names = list(self.space)
        if self.algo == "rand" or number < self.n_startup or not any(t[-2] == "ok" for t in finished):
            rows = sample_points(spark, self.space, 1, f"{self.seed}:rand{number}:")
        else:
            known = spark.createDataFrame(sorted(finished) + sorted(running), self.schema())
            rows = propose(spark, known, self.space, 1, self.n_candidates, self.gamma, self.prior_weight,
                           f"{self.seed}:{number}")
        row = rows.select(*names).first()
        return {n: row[n] for n in names}


@dataclass
class Trials:
    trials: DataFrame               # trial_id, the parameters, loss, status, error
    log: DataFrame                  # trial_id, finished, running (trial ids at its proposal)
    best: dict


LOG = "trial_id bigint, finished array<bigint>, running array<bigint>"


def run_trials(spark: SparkSession, objective: Objective, proposer: Proposer, max_evals: int = 20,
               parallelism: int = 4, on_trial=None) -> Trials:
    """``max_evals`` trials, at most ``parallelism`` at a time.
    ``objective(point)`` gives (loss, status[, error]); an exception is an
    error of the cluster: no further trial starts, and it is raised."""
    if max_evals < 1 or parallelism < 1:
        raise ValueError("max_evals and parallelism must be positive")
    finished, running, log, futures = {}, {}, [], {}
    with ThreadPoolExecutor(parallelism) as pool:
        for number in range(max_evals):
            while len(futures) >= parallelism:
                _collect(futures, running, finished, on_trial)
            point = proposer.point(spark, number, list(finished.values()), list(running.values()))
            log.append((number, sorted(finished), sorted(running)))
            running[number] = (number, *point.values(), None, "running", None)
            futures[pool.submit(inheritable_thread_target(spark)(objective), point)] = (number, point)
        while futures:
            _collect(futures, running, finished, on_trial)
    trials = spark.createDataFrame([finished[k] for k in sorted(finished)], proposer.schema())
    best = best_trial(trials, list(proposer.space)).first()
    return Trials(trials, spark.createDataFrame(log, LOG),
                  best.asDict() if best and best["trial_id"] is not None else {})


def _collect(futures: dict, running: dict, finished: dict, on_trial) -> None:
    """Wait for one trial at least, and move what has ended."""
    for f in wait(futures, return_when=FIRST_COMPLETED).done:
        number, point = futures.pop(f)
        loss, status, *error = f.result()
        del running[number]
        status = status if loss is not None else "fail"
        finished[number] = (number, *point.values(), None if loss is None else float(loss), status,
                            error[0] if error else None)
        if on_trial is not None:
            on_trial(number, point, loss, status)


def replay(spark: SparkSession, log: DataFrame, trials: DataFrame, proposer: Proposer) -> list[dict]:
    """The points of the logged trials, proposed again (both tables are
    bounded by the number of trials)."""
    done = {r.trial_id: tuple(r) for r in trials.select("trial_id", *proposer.space, "loss", "status", "error").collect()}
    points = []
    for row in log.orderBy("trial_id").collect():
        running = [(*done[k][:-3], None, "running", None) for k in row.running]
        points.append(proposer.point(spark, row.trial_id, [done[k] for k in row.finished], running))
    return points


def fit_objective(train: DataFrame, val: DataFrame, num_classes: int, base, metric: str = "val_loss", **kw) -> Objective:
    """``search.fused_fit_objective`` for one point at a time: every trial is a
    distributed fit of its own, over one shared feed (``objective.cache``)."""
    from flowline.operators.search import fused_fit_objective
    many = fused_fit_objective(train, val, num_classes, base, metric, **kw)

    def objective(point: dict) -> tuple:
        return many([point])[0]

    objective.cache = many.cache
    return objective
