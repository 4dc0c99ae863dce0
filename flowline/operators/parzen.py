"""Adaptive proposals: a tree-structured Parzen estimator as one DataFrame plan.

The successful trials are split by loss into the best ``gamma`` share ("good")
and the rest ("bad"); trials that still run count as bad, so that concurrent
proposals keep apart.  Each side gives every parameter a density:

- numbers, on the unit scale (log scale for ``loguniform``): one kernel per
  trial and one prior kernel (mean 1/2, scale 1, weight ``prior_weight``).  A
  kernel's bandwidth is its distance to the farther of its two neighbours, the
  prior's mean included, within [1 / min(100, 1 + kernels), 1].  Kernels are
  logistic, cut to [0, 1]: their distribution function and its inverse are
  plain expressions, so draws need no rejection;
- choices: frequencies with ``prior_weight`` added to every option.

Candidates are drawn from the good side's densities (uniform numbers come from
hashes of a key), and score  sum over parameters of log good - log bad.

The history is one row of arrays (as many elements as trials, which
``max_evals`` bounds) that enters as a scalar subquery: no join, no window, and
no job runs while a plan is built.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Scale of a logistic distribution of standard deviation 1.
LOGISTIC = math.sqrt(3.0) / math.pi
SIDES = ("good", "bad")


def _unit(spec, value: str) -> str:
    """SQL: a number on the unit scale of its parameter."""
    value = f"ln({value})" if spec[0] == "loguniform" else value
    return f"(CAST({value} AS DOUBLE) - {spec[1]!r}D) / {spec[2] - spec[1]!r}D"


def _hashed(key: str, salt: str) -> str:
    """SQL: ``functions.hash_unit`` of a column."""
    return f"CAST(conv(substring(md5(concat('{salt}', CAST({key} AS STRING))), 1, 8), 16, 10) AS BIGINT) / 4294967296.0D"


def _literal(option) -> str:
    if isinstance(option, str):
        return "'" + option.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{option!r}D" if isinstance(option, float) else f"{option}L"


def parzen_model(trials: DataFrame, space: dict, gamma: float = 0.25, prior_weight: float = 1.0,
                 trial: str = "trial_id") -> DataFrame:
    """One row: for each parameter and side the kernels (value, scale, weight,
    low, span; the prior last), or the observed options."""
    fields = "".join(f", '{n}', " + (f"`{n}`" if spec[0] == "choice" else _unit(spec, f"`{n}`")) for n, spec in space.items())
    seen = f"named_struct('loss', CAST(loss AS DOUBLE), 'trial', `{trial}`{fields})"
    lists = trials.selectExpr(
        f"array_sort(collect_list(CASE WHEN status = 'ok' AND loss IS NOT NULL THEN {seen} END)) AS done",
        f"array_sort(collect_list(CASE WHEN status = 'running' THEN {seen} END)) AS running")
    n_good = f"greatest(1, CAST(ceil(size(done) * {float(gamma)!r}D) AS INT))"
    sides = lists.selectExpr(f"slice(done, 1, {n_good}) AS good",
                             f"concat(slice(done, {n_good} + 1, greatest(size(done), 1)), running) AS bad")
    prior = "array(named_struct('value', 0.5D, 'prior', true))"
    means = sides.selectExpr(*[
        f"transform({side}, s -> s.`{n}`) AS `{side}_{n}`" if spec[0] == "choice" else
        f"array_sort(concat(transform({side}, s -> named_struct('value', s.`{n}`, 'prior', false)), {prior})) AS `{side}_{n}`"
        for n, spec in space.items() for side in SIDES])
    # neighbours' distances, then the mass of each kernel within [0, 1]; of equal means the order is no matter
    wide = means.selectExpr(*[f"`{c}`" if space[c.split("_", 1)[1]][0] == "choice" else f"""
        transform(`{c}`, (s, i) -> named_struct('prior', s.prior, 'value', s.value, 'scale', {LOGISTIC!r}D * CASE WHEN s.prior THEN 1.0D
            ELSE least(1.0D, greatest(1.0D / least(100.0D, size(`{c}`) + 1.0D),
                                      s.value - get(`{c}`, i - 1).value, get(`{c}`, i + 1).value - s.value)) END)) AS `{c}`"""
                              for c in means.columns])
    kernel = f"""named_struct('value', k.value, 'scale', k.scale, 'weight', CASE WHEN k.prior THEN {float(prior_weight)!r}D ELSE 1.0D END,
        'low', 1 / (1 + exp(k.value / k.scale)), 'span', 1 / (1 + exp((k.value - 1) / k.scale)) - 1 / (1 + exp(k.value / k.scale)))"""
    return wide.selectExpr(*[f"`{c}`" if space[c.split("_", 1)[1]][0] == "choice" else
                             f"transform(concat(filter(`{c}`, k -> NOT k.prior), filter(`{c}`, k -> k.prior)), k -> {kernel}) AS `{c}`"
                             for c in means.columns])


def _with_model(df: DataFrame, model: DataFrame) -> DataFrame:
    return df.withColumn("_model", model.select(F.struct("*")).scalar())


def draw(keyed: DataFrame, key: str, model: DataFrame, space: dict, salt: str = "", prior_weight: float = 1.0) -> DataFrame:
    """``keyed`` with one column per parameter, drawn from the good side; the
    column ``key`` makes the random numbers."""
    columns = []
    for name, spec in space.items():
        seen = f"_model.`good_{name}`"
        which, where = _hashed(f"`{key}`", f"{salt}{name}:which"), _hashed(f"`{key}`", f"{salt}{name}:where")
        if spec[0] == "choice":
            k, options = len(spec[1]), f"array({', '.join(map(_literal, spec[1]))})"
            at = f"({which} * (size({seen}) + {float(prior_weight) * k!r}D))"
            columns.append(f"""CASE WHEN {at} < size({seen}) THEN get({seen}, CAST(floor({at}) AS INT))
                ELSE get({options}, least(CAST(floor(({at} - size({seen})) / {float(prior_weight)!r}D) AS INT), {k - 1})) END AS `{name}`""")
        else:
            kernels = f"(size({seen}) - 1)"                   # those of trials; the prior's comes after them
            at = f"least(CAST(floor({which} * ({kernels} + {float(prior_weight)!r}D)) AS INT), {kernels})"
            x = f"""transform(transform(array(get({seen}, {at})), k -> named_struct('k', k, 'p', k.low + {where} * k.span)),
                x -> least(greatest(x.k.value + x.k.scale * ln(x.p / (1 - x.p)), 0.0D), 1.0D))[0]"""
            value = f"{spec[1]!r}D + {spec[2] - spec[1]!r}D * {x}"
            columns.append(f"{f'exp({value})' if spec[0] == 'loguniform' else value} AS `{name}`")
    return _with_model(keyed, model).selectExpr(*[f"`{c}`" for c in keyed.columns if c not in space], *columns)


def density(kernels: str, x: str) -> str:
    """SQL: the mixture's density at a point of the unit scale."""
    e = f"exp(-abs(({x} - k.value) / k.scale))"
    return (f"aggregate({kernels}, 0.0D, (t, k) -> t + k.weight * {e} / ((1 + {e}) * (1 + {e}) * k.scale * k.span))"
            f" / aggregate({kernels}, 0.0D, (t, k) -> t + k.weight)")


def score(candidates: DataFrame, model: DataFrame, space: dict, prior_weight: float = 1.0, out: str = "score") -> DataFrame:
    """``candidates`` with  sum over parameters of log good - log bad."""
    terms = []
    for name, spec in space.items():
        for side, sign in zip(SIDES, "+-"):
            seen = f"_model.`{side}_{name}`"
            if spec[0] == "choice":
                p = (f"(size(filter({seen}, v -> v = `{name}`)) + {float(prior_weight)!r}D)"
                     f" / (size({seen}) + {float(prior_weight) * len(spec[1])!r}D)")
            else:
                p = density(seen, _unit(spec, f"`{name}`"))
            terms.append(f"{sign} ln({p})")
    return _with_model(candidates, model).selectExpr(*[f"`{c}`" for c in candidates.columns], f"0.0D {' '.join(terms)} AS `{out}`")


def propose(spark: SparkSession, trials: DataFrame, space: dict, n: int = 1, n_candidates: int = 24,
            gamma: float = 0.25, prior_weight: float = 1.0, seed: str = "tpe") -> DataFrame:
    """``n`` points (point_id, the parameters, score): each the best of its own
    ``n_candidates`` draws.  Lazy; same history and seed, same points."""
    model = parzen_model(trials, space, gamma, prior_weight)
    keys = spark.range(0, n * n_candidates, 1, 1).select("id", F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).alias("_key"))
    scored = score(draw(keys, "_key", model, space, "", prior_weight), model, space, prior_weight)
    best = F.max_by(F.struct(*space, "score"), F.struct("score", -F.col("id")))
    return (scored.groupBy(F.floor(F.col("id") / n_candidates).alias("point_id")).agg(best.alias("best"))
            .select("point_id", "best.*"))
