"""Hyper-parameter search.

* Search space: ``choice``, ``uniform(lo, hi)``, ``loguniform(lo, hi)`` (natural
  log bounds, as ``exp(U(lo, hi))``).  Points are pure functions of a key
  and a salt (md5 -> u in [0, 1)), so any keyed table -- ``spark.range(n)`` for
  fresh proposals -- turns into points inside the plan.
* Proposal: random, or adaptive (``operators/parzen.py``: candidates drawn from
  the good trials' densities, with a bandwidth per kernel).  ``tpe_scores`` is
  the plain ratio of two Parzen densities with one fixed Gaussian bandwidth
  ``bw`` and add-one smoothed choices, for candidates of any origin.  In both
  the trial history (bounded by ``max_evals``) enters the plan as arrays of a
  scalar subquery -- no cross join, no job while the plan is built.
* Evaluation: an objective over a *batch* of points; ``fused_fit_objective``
  trains all points of a round in one data pass per step (trials sharing a
  batch size are fused).
* Failed trials keep a row with a null loss and never win.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowline.functions.columns import hash_unit


# ---------------------------------------------------------------- space
def choice(*options):
    return ("choice", list(options))


def uniform(lo: float, hi: float):
    return ("uniform", float(lo), float(hi))


def loguniform(lo: float, hi: float):
    return ("loguniform", float(lo), float(hi))


def point_columns(key, space: dict, salt: str = "") -> list[Column]:
    """One column per parameter, derived from ``key``."""
    cols = []
    for name, spec in space.items():
        u = hash_unit(key, f"{salt}{name}")
        if spec[0] == "choice":
            opts = F.array(*[F.lit(o) for o in spec[1]])
            c = F.element_at(opts, (F.floor(u * len(spec[1])) + 1).cast("int"))
        elif spec[0] == "uniform":
            c = F.lit(spec[1]) + (spec[2] - spec[1]) * u
        elif spec[0] == "loguniform":
            c = F.exp(F.lit(spec[1]) + (spec[2] - spec[1]) * u)
        else:
            raise ValueError(f"unknown distribution {spec[0]!r}")
        cols.append(c.alias(name))
    return cols


def sample_points(spark: SparkSession, space: dict, n: int, salt: str = "rand") -> DataFrame:
    """``n`` random points (ids 0..n-1); same salt, same points."""
    return spark.range(n).select(F.col("id").alias("point_id"), *point_columns("id", space, salt))


def param_type(spec) -> str:
    """Spark SQL type of a parameter's values."""
    if spec[0] != "choice":
        return "double"
    opts = spec[1]
    if all(isinstance(o, str) for o in opts):
        return "string"
    if all(isinstance(o, int) and not isinstance(o, bool) for o in opts):
        return "bigint"
    return "double"


def unit_value(name: str, spec, col: Column | None = None) -> Column:
    """Numeric parameter mapped to [0, 1) (log scale for loguniform)."""
    c = F.col(name) if col is None else col
    if spec[0] == "uniform":
        return (c - spec[1]) / (spec[2] - spec[1])
    return (F.log(c) - spec[1]) / (spec[2] - spec[1])


# ---------------------------------------------------------------- trials
def ok_trials(trials: DataFrame) -> DataFrame:
    return trials.filter((F.col("status") == "ok") & F.col("loss").isNotNull())


def best_trial(trials: DataFrame, space_names: list[str], trial: str = "trial_id") -> DataFrame:
    """argmin of loss over successful trials; ties by trial id."""
    key = F.struct("loss", trial)
    return ok_trials(trials).agg(
        F.min_by(F.col(trial), key).alias(trial),
        F.min("loss").alias("loss"),
        *[F.min_by(F.col(n), key).alias(n) for n in space_names])


def split_good_bad(trials: DataFrame, gamma: float, trial: str = "trial_id") -> DataFrame:
    """Label successful trials good/bad: the ``max(1, ceil(gamma * n))`` lowest
    losses (ties by id) are good.  Trials are few (bounded by max_evals)."""
    ok = ok_trials(trials)
    n_ok = ok.agg(F.count(F.lit(1))).scalar()
    n_good = F.greatest(F.lit(1).cast("bigint"), F.ceil(n_ok * F.lit(float(gamma))))
    # one window over the (bounded) trial history
    r = F.row_number().over(Window.orderBy("loss", trial)) - 1
    return ok.withColumn("good", r < n_good)


def tpe_scores(candidates: DataFrame, trials: DataFrame, space: dict, gamma: float = 0.25,
               bw: float = 0.2, trial: str = "trial_id") -> DataFrame:
    """Adds ``score`` = sum_d log l_d(x) - log g_d(x) to every candidate.

    The good/bad trial values are aggregated into ONE row of arrays -- the
    history is the search state, bounded by ``max_evals`` -- and enter the
    plan by a scalar subquery; kernels are per-row array expressions, so no
    candidate x trial pairs are ever materialised, no join is needed, and no
    job runs while the plan is built."""
    labelled = split_good_bad(trials, gamma, trial)
    aggs = []
    for name, spec in space.items():
        v = F.col(name) if spec[0] == "choice" else unit_value(name, spec)
        for side, flag in (("l", True), ("g", False)):
            aggs.append(F.collect_list(F.when(F.col("good") == F.lit(flag), v)).alias(f"_h_{side}_{name}"))
    hist = labelled.agg(*aggs).select(F.struct("*")).scalar()     # one row, bounded by the trial count
    candidates = candidates.withColumn("_hist", hist)
    score = F.lit(0.0)
    for name, spec in space.items():
        for side in ("l", "g"):
            vals = F.col("_hist")[f"_h_{side}_{name}"]
            if spec[0] == "choice":
                k = len(spec[1])
                dens = (F.size(F.filter(vals, lambda v: v == F.col(name))) + F.lit(1.0)) / \
                       (F.size(vals) + F.lit(float(k)))
            else:
                x = unit_value(name, spec)
                kern = F.aggregate(vals, F.lit(0.0),
                                   lambda s, v: s + F.exp(-(x - v) * (x - v) / F.lit(2 * bw * bw)))
                norm = F.lit(1.0 / (bw * math.sqrt(2 * math.pi)))
                # a flat prior (weight 1 of n+1) keeps densities positive
                dens = (kern * norm + F.lit(1.0)) / (F.size(vals) + F.lit(1.0))
            term = F.log(dens)
            score = score + term if side == "l" else score - term
    return candidates.withColumn("score", score).drop("_hist")


def tpe_propose(trials: DataFrame, space: dict, n: int, round_id: int, n_candidates: int = 24,
                gamma: float = 0.25, prior_weight: float = 1.0, seed: str = "tpe") -> DataFrame:
    """``n`` points, each the best of ``n_candidates`` draws from the good
    trials' densities (``parzen.propose``)."""
    from flowline.operators.parzen import propose
    return propose(trials.sparkSession, trials, space, n, n_candidates, gamma, prior_weight, f"{seed}{round_id}")


# ---------------------------------------------------------------- driver loop
@dataclass
class SearchResult:
    trials: DataFrame           # trial_id, params..., loss, status
    best: dict


def run_search(spark: SparkSession, objective, space: dict, max_evals: int = 20,
               parallelism: int = 4, algo: str = "tpe", n_startup: int = 4,
               n_candidates: int = 24, gamma: float = 0.25, seed: str = "search",
               on_trial=None) -> SearchResult:
    """Rounds of ``parallelism`` points; proposals for round r see the
    results of rounds < r.  ``objective(points: list[dict]) -> list[(loss,
    status[, error])]`` evaluates a whole round (e.g. fused training)."""
    names = list(space)
    schema = "trial_id bigint, " + ", ".join(f"{n} {param_type(space[n])}" for n in names) + \
        ", loss double, status string, error string"
    history: list[tuple] = []
    rnd = 0
    while len(history) < max_evals:
        k = min(parallelism, max_evals - len(history))
        if algo == "rand" or len(history) < n_startup or not any(h[-2] == "ok" for h in history):
            pts = sample_points(spark, space, k, f"{seed}:rand{rnd}:")
        else:
            done = spark.createDataFrame(history, schema)
            pts = tpe_propose(done, space, k, rnd, n_candidates, gamma, seed=f"{seed}:tpe")
        points = [{n: r[n] for n in names} for r in pts.select(*names).collect()]   # k rows
        results = objective(points)
        for p, (loss, status, *error) in zip(points, results):
            tid = len(history)
            history.append((tid, *[p[n] for n in names], None if loss is None else float(loss),
                            status if loss is not None else "fail", error[0] if error else None))
            if on_trial:
                on_trial(tid, p, loss, status)
        rnd += 1
    trials = spark.createDataFrame(history, schema)
    best = best_trial(trials, names).first()
    return SearchResult(trials, best.asDict() if best and best["trial_id"] is not None else {})


def trial_config(base, point: dict):
    """A training config with a point's hyper-parameters applied."""
    kw = {k: v for k, v in point.items() if k in ("learning_rate", "dropout", "optimizer", "batch_size")}
    if "optimizer" in kw:
        kw["optimizer"] = str(kw["optimizer"]).lower()
    if "batch_size" in kw:
        kw["batch_size"] = int(kw["batch_size"])
    return replace(base, **kw)


def config_fault(config) -> str | None:
    """Why a configuration can't be trained, or None."""
    if config.optimizer not in ("adam", "adadelta", "sgd"):
        return f"unknown optimizer {config.optimizer!r}"
    if not config.learning_rate > 0 or not math.isfinite(config.learning_rate):
        return f"learning rate {config.learning_rate} is not positive"
    if not 0 <= config.dropout < 1:
        return f"dropout {config.dropout} is not in [0, 1)"
    if config.batch_size < 1 or config.epochs < 1:
        return "batch size and epochs must be positive"
    return None


def checkpoint_name(point: dict) -> str:
    """Folder name of a trial from its hyper-parameters, e.g.
    ``learning_rate_0.01_dropout_0.5_batch_size_64``."""
    return "_".join(f"{k}_{point[k]}" for k in sorted(point))


def fused_fit_objective(train: DataFrame, val: DataFrame, num_classes: int, base,
                        metric: str = "val_loss", store=None, parent_run_id: str | None = None,
                        checkpoint_root: str | None = None, on_fit=None):
    """Objective for ``run_search``: fits every point of a round with the
    distributed trainer, fusing points that share a batch size, and returns
    (``metric``, status, error), the metric negated if larger is better.

    A point that can't be trained fails alone, with its reason; an error of
    the cluster is raised.  A trial's masks depend on its own seed, so its
    result is the same in any company.  With a store each trial is a child
    run (FAILED if it failed); ``on_fit(run_id, fit)`` may add to it.  Call
    ``objective.cache.release()`` (or use it as a context) when done."""
    from flowline.operators import trainer as TR
    from flowline.operators.runs import lower_is_better

    cache = TR.FeedCache(train, val)
    sign = 1 if lower_is_better(metric) else -1
    done = 0
    folders: dict = {}              # trials of each folder's name so far

    def record(point, fit, error):
        nonlocal done
        if store is not None:
            rid = store.start_run(f"trial_{done}", parent_run_id)
            store.log_params(rid, {**point, **({"error": error} if error else {})})
            if fit is not None:
                store.log_history(rid, fit.history)
                if error is None and on_fit is not None:
                    on_fit(rid, fit)
            store.end_run(rid, "FAILED" if error else "FINISHED")
        done += 1

    def objective(points):
        cfgs = [trial_config(base, p) for p in points]
        fits: list = [None] * len(points)
        errors = [config_fault(c) for c in cfgs]
        groups: dict = {}
        for i, c in enumerate(cfgs):
            if errors[i] is None:
                groups.setdefault((c.batch_size, c.workers, c.local_steps), []).append(i)
        for idx in groups.values():
            on_epoch = None
            if checkpoint_root is not None:
                from flowline.sources import tables as TB
                spark = train.sparkSession

                # one checkpoint per trial and epoch, in a folder named after
                # the trial's hyper-parameters; equal points are told apart
                own = {}
                for i in idx:
                    name = checkpoint_name(points[i])
                    folders[name] = folders.get(name, 0) + 1
                    own[i] = name if folders[name] == 1 else f"{name}_trial_{folders[name]}"

                def on_epoch(epoch, W, histories, states, idx=idx, own=own):
                    for j, i in enumerate(idx):
                        TB.save_checkpoint(spark, f"{checkpoint_root}/{own[i]}",
                                           "trial", epoch, W[j, :-1], W[j, -1])
            for i, f in zip(idx, TR.fit_many(train, val, num_classes, [cfgs[i] for i in idx], feed=cache,
                                             on_epoch=on_epoch)):
                fits[i] = f
        out = []
        for p, f, error in zip(points, fits, errors):
            value = f.final.get(metric) if f is not None else None
            if error is None and (value is None or not math.isfinite(value)):
                error = f"{metric} is {value}"
            record(p, f, error)
            out.append((None, "fail", error) if error else (sign * value, "ok", None))
        return out

    objective.cache = cache
    return objective
