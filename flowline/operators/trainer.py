"""Synchronous data-parallel training of a softmax head over a feature table.

The trainable part of the original network is one dense layer after frozen,
pooled features, trained with sparse categorical cross-entropy on logits:
multinomial logistic regression.  Features are computed once (they are
frozen) and written as a snapshot.  A step needs the weights of the one before,
and a small step's arithmetic takes far less than a Spark job, so consecutive
small steps are made in one job (``run_steps``): each task streams the rows of
the job's steps in order and makes the steps of its share of the fused trials.
A step of ``STEP_VALUES`` values or more, an evaluation and a gradient are a job
each, spread over the data's partitions:

    weights (broadcast, D x K) -> mapInPandas, one array of partial sums per
    partition -> added up ``FAN_IN`` at a time in the JVM (the all-reduce) ->
    optimizer on the driver

Driver and tasks only ever hold model-sized arrays (trials x (D+1) x K).  Several
trials that share a batch size are fused: one scan computes every trial's
gradient (hyper-parameter search, H3).

Randomness (initial weights aside) is hash-derived from (seed, trial, epoch,
step, row key, feature position), so a retried task computes the same mask
and the result does not depend on partitioning.
"""

from __future__ import annotations

import math
import pickle
import threading
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowline.operators.feed import steps_per_epoch, visits, with_positions
from flowline.operators.runs import log_evaluation, log_fit
from flowline.session import scratch_path
from flowline.sources.tables import Snapshot

PARTIAL_SCHEMA = "t int, k int, pos int, g double"
SUMS_SCHEMA = "part int, place int, n long, known long, sums array<double>"
# Partial sums that one task merges.
FAN_IN = 64
# Extra partial rows (k = 0) carry statistics next to the gradient cells.
POS_LOSS, POS_CORRECT, POS_COUNT = -1, -2, -3
# Feature values of a step from which on it is a job of its own, and of all
# the smaller steps that one job makes.
STEP_VALUES, RUN_VALUES = 1 << 21, 1 << 24

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def _mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, vectorised (wrapping uint64 arithmetic)."""
    with np.errstate(over="ignore"):
        z = x + _M1
        z = (z ^ (z >> np.uint64(30))) * _M2
        z = (z ^ (z >> np.uint64(27))) * _M3
        return z ^ (z >> np.uint64(31))


def dropout_keep(keys: np.ndarray, dim: int, rate: float, seed: int, trial: int,
                 epoch: int, step: int) -> np.ndarray:
    """Boolean keep-mask (rows x dim) that is a pure function of its inputs."""
    if rate <= 0:
        return np.ones((len(keys), dim), dtype=bool)
    base = _mix64(np.array([(seed * 1_000_003 + trial) * 1_000_003 + epoch], dtype=np.uint64))
    base = _mix64(base ^ np.uint64(step))
    with np.errstate(over="ignore"):
        row = _mix64(base ^ keys.astype(np.uint64))
        z = _mix64(row[:, None] + np.arange(dim, dtype=np.uint64)[None, :] * _M1)
    u = (z >> np.uint64(11)).astype(np.float64) * (1.0 / 9007199254740992.0)
    return u >= rate


def _softmax_rows(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def batch_partials(X: np.ndarray, y: np.ndarray, keys: np.ndarray, weights: np.ndarray,
                   dropout: np.ndarray, seeds, epoch: int, step: int, train: bool,
                   grad: np.ndarray, loss: np.ndarray, correct: np.ndarray,
                   trial_ids=None) -> int:
    """Add one block of rows' gradient sums, loss sums and hits (all trials)
    into the accumulators; returns the number of rows with a known class.

    ``seeds`` (one, or one per trial) and ``trial_ids`` key each trial's
    dropout masks, so they don't change with its place in a fused pass.  A
    class that the head doesn't have (an unseen label kept as index K) gives
    neither loss nor gradient and is a miss."""
    T, D1, K = weights.shape
    D = D1 - 1
    known = (y >= 0) & (y < K)
    X, y, keys = X[known], y[known], keys[known]
    rows = np.arange(len(y))
    ids = [0] * T if trial_ids is None else trial_ids
    seeds = [seeds] * T if np.ndim(seeds) == 0 else seeds
    for t, tid in zip(range(T), ids):
        Xt = X
        if train and dropout[t] > 0:
            keep = dropout_keep(keys, D, float(dropout[t]), int(seeds[t]), int(tid), epoch, step)
            Xt = np.where(keep, X / (1.0 - dropout[t]), 0.0)
        z = Xt @ weights[t, :D, :] + weights[t, D, :]
        zmax = z.max(axis=1, keepdims=True)
        lse = zmax[:, 0] + np.log(np.exp(z - zmax).sum(axis=1))
        loss[t] += float((lse - z[rows, y]).sum())
        correct[t] += float((z.argmax(axis=1) == y).sum())
        if train:
            r = _softmax_rows(z)
            r[rows, y] -= 1.0
            grad[t, :D, :] += Xt.T @ r
            grad[t, D, :] += r.sum(axis=0)
    return len(y)


def _accumulate(batches, weights, dropout, seeds, epoch, step, train, feature_col, label_col, key_col, trial_ids):
    """(grad, loss, correct, rows, rows of a known class) of one partition."""
    T, D1, K = weights.shape
    grad, loss, correct = np.zeros((T, D1, K)), np.zeros(T), np.zeros(T)
    n = known = 0
    for pdf in batches:
        if len(pdf) == 0:
            continue
        times = pdf["visits"].to_numpy(np.int64) if "visits" in pdf.columns else np.ones(len(pdf), np.int64)
        X = np.repeat(np.stack(pdf[feature_col].to_numpy()).astype(np.float64), times, axis=0)
        y = np.repeat(pdf[label_col].to_numpy().astype(np.int64), times)
        keys = np.repeat(pdf[key_col].to_numpy().astype(np.int64), times)
        n += len(y)
        known += batch_partials(X, y, keys, weights, dropout, seeds, epoch, step, train, grad, loss, correct,
                                trial_ids)
    return grad, loss, correct, n, known


def partial_sums(batches, weights: np.ndarray, dropout: np.ndarray, seeds,
                 epoch: int, step: int, train: bool, feature_col: str,
                 label_col: str, key_col: str, trial_ids=None):
    """mapInPandas body: one partition in, its sums as one row per cell out.

    weights: (T, D+1, K) with the bias in the last row."""
    T, D1, K = weights.shape
    grad, loss, correct, n, known = _accumulate(batches, weights, dropout, seeds, epoch, step, train,
                                                feature_col, label_col, key_col, trial_ids)
    t = np.repeat(np.arange(T, dtype=np.int32), 3)
    out = pd.DataFrame({"t": t, "k": np.zeros(3 * T, np.int32),
                        "pos": np.tile(np.array([POS_LOSS, POS_CORRECT, POS_COUNT], np.int32), T),
                        "g": np.stack([loss, correct, np.full(T, float(known))], axis=1).ravel()})
    if train and n:
        tt, pp, kk = np.meshgrid(np.arange(T), np.arange(D1), np.arange(K), indexing="ij")
        cells = pd.DataFrame({"t": tt.ravel().astype(np.int32), "k": kk.ravel().astype(np.int32),
                              "pos": pp.ravel().astype(np.int32), "g": grad.ravel()})
        out = pd.concat([out, cells], ignore_index=True)
    yield out


def all_reduce(df: DataFrame, weights: np.ndarray, dropout: np.ndarray, seeds,
               epoch: int, step: int, train: bool, feature_col: str = "features",
               label_col: str = "label_idx", key_col: str = "row_id", trial_ids=None):
    """Run one distributed pass; returns (grad_sums (T,D+1,K), loss_sums (T,),
    correct (T,), rows, rows of a known class).  Gradient sums are not yet
    divided.

    Each input partition gives one array (``partial_arrays``, the step's only
    Python stage); ``tree_sums`` adds up to ``FAN_IN`` of them per group in the
    JVM, so the driver adds partitions / FAN_IN arrays of the model's size.  A
    ``visits`` column, if there, repeats rows."""
    T, D1, K = weights.shape
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((np.array(weights, dtype=np.float64), np.array(dropout, dtype=np.float64)))
    ids = None if trial_ids is None else [int(i) for i in trial_ids]
    fan_in = FAN_IN

    def partial(it):
        from pyspark import TaskContext
        w, d = shared.value
        grad, loss, correct, n, known = _accumulate(it, w, d, seeds, epoch, step, train,
                                                    feature_col, label_col, key_col, ids)
        place = TaskContext.get().partitionId()
        yield sums_row(place // fan_in, place, n, known, loss, correct, grad if train else None)

    cols = [key_col, feature_col, label_col] + (["visits"] if "visits" in df.columns else [])
    merged = tree_sums(df.select(*cols).mapInPandas(partial, SUMS_SCHEMA)).collect()
    shared.unpersist()
    return total_of(merged, (T, D1, K), train)


def sums_row(part: int, place: int, n: int, known: int, loss: np.ndarray, correct: np.ndarray,
             grad: np.ndarray | None) -> pd.DataFrame:
    """One task's sums as a row of ``SUMS_SCHEMA``."""
    sums = np.concatenate([loss, correct, [] if grad is None else grad.ravel()])
    return pd.DataFrame({"part": np.array([part], np.int32), "place": np.array([place], np.int32),
                         "n": np.array([n], np.int64), "known": np.array([known], np.int64), "sums": [sums]})


def tree_sums(parts: DataFrame) -> DataFrame:
    """(part, n, known, sums): the rows of each ``part`` added up in the JVM,
    in the order of their ``place``, so that the result repeats to the bit."""
    def add(total, row):
        return F.when(F.size(total) == 0, row["sums"]).otherwise(
            F.zip_with(total, row["sums"], lambda x, y: x + y))

    rows = F.array_sort(F.collect_list(F.struct("place", "sums")))
    return parts.groupBy("part").agg(F.sum("n").alias("n"), F.sum("known").alias("known"), rows.alias("rows")).select(
        "part", "n", "known", F.aggregate("rows", F.array().cast("array<double>"), add).alias("sums"))


def total_of(merged: list, shape: tuple, train: bool):
    """(grad, loss, correct, rows, known) of collected ``tree_sums``."""
    T, D1, K = shape
    total = np.zeros(2 * T + (T * D1 * K if train else 0))
    for row in sorted(merged, key=lambda r: r["part"]):
        total += np.array(row["sums"])
    grad = total[2 * T:].reshape(T, D1, K) if train else np.zeros((T, D1, K))
    return (grad, total[:T].copy(), total[T:2 * T].copy(), sum(r["n"] for r in merged),
            sum(r["known"] for r in merged))


# ---------------------------------------------------------------- optimizers
class Optimizer:
    """Standard update rules on (D+1) x K arrays (Adam: beta1 0.9, beta2 0.999,
    eps 1e-7; Adadelta: rho 0.95, eps 1e-7; plain SGD)."""

    def __init__(self, name: str, shape):
        self.name = name.lower()
        if self.name not in ("adam", "adadelta", "sgd"):
            raise ValueError(f"unknown optimizer {name!r}")
        self.t = 0
        self.m = np.zeros(shape)
        self.v = np.zeros(shape)

    def state(self) -> dict:
        return {"t": self.t, "m": self.m.copy(), "v": self.v.copy()}

    def restore(self, state: dict) -> None:
        self.t, self.m, self.v = int(state["t"]), np.array(state["m"]), np.array(state["v"])

    def update(self, w: np.ndarray, g: np.ndarray, lr: float) -> np.ndarray:
        self.t += 1
        if self.name == "sgd":
            return w - lr * g
        if self.name == "adam":
            b1, b2, eps = 0.9, 0.999, 1e-7
            self.m = b1 * self.m + (1 - b1) * g
            self.v = b2 * self.v + (1 - b2) * g * g
            lr_t = lr * math.sqrt(1 - b2 ** self.t) / (1 - b1 ** self.t)
            return w - lr_t * self.m / (np.sqrt(self.v) + eps)
        rho, eps = 0.95, 1e-7                       # adadelta
        self.m = rho * self.m + (1 - rho) * g * g   # accumulated gradient
        delta = np.sqrt(self.v + eps) / np.sqrt(self.m + eps) * g
        self.v = rho * self.v + (1 - rho) * delta * delta  # accumulated update
        return w - lr * delta


# ---------------------------------------------------------------- schedules
def warmup_lr(target: float, workers: int, epoch_frac: float, warmup_epochs: int) -> float:
    if warmup_epochs <= 0 or epoch_frac >= warmup_epochs or workers <= 1:
        return target
    return target / workers * (1.0 + epoch_frac * (workers - 1) / warmup_epochs)


@dataclass
class Plateau:
    """Reduce the learning rate when the monitored value stops improving."""
    patience: int = 10
    factor: float = 0.1
    min_delta: float = 1e-4
    min_lr: float = 0.0
    best: float = math.inf
    wait: int = 0
    scale: float = 1.0

    def observe(self, value: float, lr: float | None = None) -> None:
        """One epoch's monitored value; after ``patience`` epochs without an
        improvement larger than ``min_delta`` the rate is multiplied by
        ``factor`` (``apply`` enforces ``min_lr``)."""
        if value < self.best - self.min_delta:
            self.best, self.wait = value, 0
            return
        self.wait += 1
        if self.wait >= self.patience:
            self.scale *= self.factor
            self.wait = 0

    def apply(self, lr: float) -> float:
        return max(lr * self.scale, self.min_lr)


def early_stop_epoch(values: list[float], patience: int, min_delta: float = 0.0) -> int | None:
    """Epoch index (0-based) after which training stops, or None.

    The best value moves only when beaten by more than ``min_delta``; a plain
    running minimum is not the same rule."""
    best, wait = math.inf, 0
    for i, v in enumerate(values):
        if v < best - min_delta:
            best, wait = v, 0
        else:
            wait += 1
            if wait >= patience:
                return i
    return None


# ---------------------------------------------------------------- fit
@dataclass
class TrainConfig:
    epochs: int = 3
    batch_size: int = 256
    workers: int = 2
    learning_rate: float = 1e-3
    optimizer: str = "adam"
    dropout: float = 0.5
    seed: int = 42
    scale_lr: bool = True           # lr x workers (linear scaling rule)
    warmup_epochs: int = 0          # 5 in the distributed recipe
    plateau_patience: int | None = None
    early_stop_patience: int | None = None
    early_stop_min_delta: float = 1e-2
    local_steps: int = 1            # steps a shard takes by itself between two averages

    def params(self) -> dict:
        return asdict(self)


@dataclass
class FitResult:
    weights: np.ndarray            # (D, K)
    bias: np.ndarray               # (K,)
    history: list = field(default_factory=list)
    config: TrainConfig | None = None
    steps_per_epoch: int = 0
    stopped_epoch: int | None = None

    @property
    def final(self) -> dict:
        return self.history[-1] if self.history else {}


def glorot(num_features: int, num_classes: int, seed: int) -> np.ndarray:
    lim = math.sqrt(6.0 / (num_features + num_classes))
    rng = np.random.default_rng(seed)
    w = np.zeros((num_features + 1, num_classes))
    w[:num_features] = rng.uniform(-lim, lim, size=(num_features, num_classes))
    return w


# Positions of a shard in one directory of the feed.
FEED_BLOCK = 65_536


def feature_snapshot(df: DataFrame, key_col: str, feature_col: str, label_col: str,
                     workers: int) -> Snapshot:
    """Features + shard + position, written once, sorted by position, one
    directory per ``FEED_BLOCK`` positions.  It serves every batch size.  A
    step's rows are found by directory and by the files' row-group statistics
    on ``pos``; use ``feed_step(snap, first, last)``."""
    spark = df.sparkSession
    staged: list = []
    path = scratch_path(spark, "feed")
    b = with_positions(df.select(key_col, feature_col, label_col), key_col, workers, staged_paths=staged)
    b = b.withColumn("pos_block", F.floor(F.col("pos") / FEED_BLOCK).cast("bigint"))
    (b.sortWithinPartitions("pos_block", "shard", "pos")
      .write.mode("overwrite").partitionBy("pos_block").parquet(path))
    snap = Snapshot(spark.read.schema(b.schema).parquet(path), written=True, cache=False, owned_paths=staged + [path])
    # one row per worker
    snap.shard_rows = {r["shard"]: r["n"] for r in snap.df.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not snap.shard_rows:
        raise ValueError("no training rows: the training table is empty")
    return snap


def feed_step(snap: Snapshot, first: int, last: int) -> DataFrame:
    """Rows ``first`` up to ``last`` of every shard's endless feed, with
    ``visits`` where the feed passes a row more than once."""
    blocks, ranges = set(), None
    for shard, n in sorted(snap.shard_rows.items()):
        begin, size = first % n, min(last - first, n)
        pieces = [(begin, min(begin + size, n))] + ([(0, begin + size - n)] if begin + size > n else [])
        for lo, hi in pieces:
            blocks.update(range(lo // FEED_BLOCK, (hi - 1) // FEED_BLOCK + 1))
            here = (F.col("shard") == shard) & (F.col("pos") >= lo) & (F.col("pos") < hi)
            ranges = here if ranges is None else ranges | here
    rows = F.create_map(*[F.lit(x) for kv in sorted(snap.shard_rows.items()) for x in kv])
    return (snap.df.filter(F.col("pos_block").isin(sorted(blocks)) & ranges)
            .withColumn("visits", visits(F.col("pos"), F.element_at(rows, F.col("shard")), first, last)))


def local_steps(snap: Snapshot, first: int, batch_size: int, count: int, weights: np.ndarray, rates: np.ndarray,
                dropout: np.ndarray, seeds, epoch: int, step: int, feature_col: str = "features",
                label_col: str = "label_idx", key_col: str = "row_id", trial_ids=None):
    """One pass of local-step averaging: every shard starts from ``weights`` and
    takes ``count`` gradient steps of its own rows, ``batch_size`` each, from
    row ``first`` of its endless feed on.  Returns what ``all_reduce`` does;
    the gradient is that of the average over shards (by rows) of the weights
    they end with: weights - rate * count * gradient / rows of a known class.

    A task holds one shard's ``count * batch_size`` rows of the pass."""
    T, D1, K = weights.shape
    shared = snap.df.sparkSession.sparkContext.broadcast((np.array(weights, np.float64), np.array(dropout, np.float64)))
    ids, rows = None if trial_ids is None else [int(i) for i in trial_ids], dict(snap.shard_rows)
    rates, fan_in = np.array(rates, np.float64)[:, None, None], FAN_IN

    def shard_pass(key, pdf):
        w0, drop = shared.value
        shard, w = int(key[0]), w0.copy()
        pdf = pdf.sort_values("pos")
        held = pdf["pos"].to_numpy(np.int64)
        X = np.stack(pdf[feature_col].to_numpy()).astype(np.float64)
        y, keys = pdf[label_col].to_numpy().astype(np.int64), pdf[key_col].to_numpy().astype(np.int64)
        loss, correct, moved, known = np.zeros(T), np.zeros(T), np.zeros((T, D1, K)), 0
        for h in range(count):
            at = np.searchsorted(held, (first + h * batch_size + np.arange(batch_size)) % rows[shard])
            grad = np.zeros((T, D1, K))
            good = batch_partials(X[at], y[at], keys[at], w, drop, seeds, epoch, step + h, True, grad, loss, correct, ids)
            known += good
            if good:
                moved += grad / good
                w = w - rates * grad / good
        return sums_row(shard // fan_in, shard, count * batch_size, known, loss, correct, moved * (known / count))

    columns = ["shard", "pos", key_col, feature_col, label_col]
    parts = (feed_step(snap, first, first + count * batch_size).select(*columns)
             .groupBy("shard").applyInPandas(shard_pass, SUMS_SCHEMA))
    merged = tree_sums(parts).collect()
    shared.unpersist()
    return total_of(merged, (T, D1, K), True)


def steps_a_job(step_rows: int, num_features: int) -> int:
    """Steps of ``step_rows`` rows that one job makes; 1: each is a job of its own."""
    values = max(1, step_rows * num_features)
    return max(1, RUN_VALUES // values) if values < STEP_VALUES else 1


def feed_run(snap: Snapshot, first: int, batch_size: int, count: int, parts: int) -> DataFrame:
    """The rows that ``count`` steps read from row ``first`` of every shard's
    endless feed on, with ``step`` (from 0), in each of ``parts`` partitions,
    sorted by step.  A row that the feed passes more than once comes as often."""
    rows = F.element_at(F.create_map(*[F.lit(x) for kv in sorted(snap.shard_rows.items()) for x in kv]), F.col("shard"))
    last = first + count * batch_size
    begin = F.floor((first - F.col("pos") + rows - 1) / rows)       # the first round of the feed that passes it
    at = (F.col("round") * rows + F.col("pos") - first).cast("bigint")
    return (feed_step(snap, first, last)
            .withColumn("round", F.explode(F.sequence(begin, begin + F.col("visits") - 1))).withColumn("at", at)
            .withColumn("step", F.floor(F.col("at") / batch_size).cast("bigint"))
            .withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(parts)])))
            .repartitionById(parts, "part").sortWithinPartitions("step", "shard", "at"))


def run_steps(snap: Snapshot, first: int, batch_size: int, count: int, weights: np.ndarray, opts: list, rate,
              dropout: np.ndarray, seeds, epoch: int, step: int, feature_col: str = "features",
              label_col: str = "label_idx", key_col: str = "row_id", trial_ids=None):
    """``count`` synchronous steps in one job, the same as a job for each: the
    gradient of a step is that of all shards' rows.  The trials are spread over
    tasks; ``rate(trial, step)`` is a trial's learning rate.  Returns (weights,
    opts, loss sums, correct, rows, rows of a known class), the sums over all
    steps.  A task streams the rows; it holds an Arrow batch and its trials."""
    T, D1, K = weights.shape
    sc = snap.df.sparkSession.sparkContext
    parts = max(1, min(T, sc.defaultParallelism))
    shared = sc.broadcast(pickle.dumps((np.array(weights, np.float64), opts, np.array(dropout, np.float64))))
    seeds = [int(x) for x in seeds]
    ids = [0] * T if trial_ids is None else [int(i) for i in trial_ids]

    def work(batches):
        w, own, drop = pickle.loads(shared.value)
        mine, part, n, known, blocks = None, 0, 0, 0, step_blocks(batches, feature_col, label_col, key_col)
        loss, correct = np.zeros(T), np.zeros(T)
        block = next(blocks, None)
        while block is not None:
            if mine is None:
                part = block[4]
                mine = np.arange(part, T, parts)
                at = [int(t) for t in mine]
                lost, hits = np.zeros(len(at)), np.zeros(len(at))
            s, grad, good = block[0], np.zeros((len(at), D1, K)), 0
            while block is not None and block[0] == s:
                _, X, y, keys, _ = block
                n += len(y)
                good += batch_partials(X, y, keys, w[mine], drop[mine], [seeds[t] for t in at], epoch, step + s, True,
                                       grad, lost, hits, [ids[t] for t in at])
                block = next(blocks, None)
            known += good
            if good:
                for g, t in zip(grad, at):
                    w[t] = own[t].update(w[t], g / good, rate(t, step + s))
            loss[mine], correct[mine] = lost, hits
        if mine is not None:
            yield pd.DataFrame({"state": [pickle.dumps((at, w[mine], [own[t] for t in at], loss, correct, n, known))]})

    columns = ["step", "part", key_col, feature_col, label_col]
    rows = feed_run(snap, first, batch_size, count, parts).select(*columns)
    w, own, loss, correct, n, known = weights.copy(), list(opts), np.zeros(T), np.zeros(T), 0, 0
    for row in rows.mapInPandas(work, "state binary").collect():         # a row per task: its trials' models
        at, done, after, lost, hits, n, known = pickle.loads(bytes(row["state"]))
        w[at], loss, correct = done, loss + lost, correct + hits
        for t, o in zip(at, after):
            own[t] = o
    shared.unpersist()
    return w, own, loss, correct, n, known


def step_blocks(batches, feature_col: str, label_col: str, key_col: str):
    """(step, features, classes, keys, part) of consecutive rows of a step."""
    for pdf in batches:
        if len(pdf) == 0:
            continue
        X = np.stack(pdf[feature_col].to_numpy()).astype(np.float64)
        y, keys = pdf[label_col].to_numpy().astype(np.int64), pdf[key_col].to_numpy().astype(np.int64)
        step, part = pdf["step"].to_numpy(np.int64), int(pdf["part"].iloc[0])
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(step)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(step[a]), X[a:b], y[a:b], keys[a:b], part


class FeedCache:
    """Feature snapshots keyed by the worker count, shared by every fit that
    uses the same shards (e.g. all rounds of a search, at any batch size)."""

    def __init__(self, train_df: DataFrame, val_df: DataFrame | None, key_col: str = "row_id",
                 feature_col: str = "features", label_col: str = "label_idx"):
        self.train_df, self.val_df = train_df, val_df
        self.cols = (key_col, feature_col, label_col)
        self._train: dict = {}
        self._val = None
        self._lock = threading.Lock()       # trials of several threads share the snapshots

    def train(self, workers: int) -> Snapshot:
        with self._lock:
            if workers not in self._train:
                self._train[workers] = feature_snapshot(self.train_df, *self.cols, workers)
            return self._train[workers]

    def val(self) -> Snapshot | None:
        with self._lock:
            if self._val is None and self.val_df is not None:
                self._val = Snapshot(self.val_df.select(*self.cols))
            return self._val

    def release(self) -> None:
        for s in self._train.values():
            s.release()
        if self._val is not None:
            self._val.release()
        self._train, self._val = {}, None

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.release()
        return False


def fit_many(train_df: DataFrame, val_df: DataFrame | None, num_classes: int,
             configs: list[TrainConfig], num_features: int | None = None,
             key_col: str = "row_id", feature_col: str = "features",
             label_col: str = "label_idx", on_epoch=None,
             init: np.ndarray | None = None, start_epoch: int = 0,
             feed: FeedCache | None = None, trial_ids: list[int] | None = None,
             resume: list[dict] | None = None) -> list[FitResult]:
    """Fit several configurations in lock-step, one data pass per step.

    All configurations must share ``batch_size`` and ``workers`` (the shard
    and batch layout); group them by those before calling.  Pass a
    ``FeedCache`` to reuse snapshots across calls.  ``trial_ids`` key the
    dropout masks together with each configuration's seed (by default all 0:
    a trial's fit doesn't depend on its company).

    Step t of the whole fit reads rows t*B up to (t+1)*B of every shard's
    endless feed, so an epoch goes on where the last one ended and no row is
    left out.  ``on_epoch(epoch, W, histories, states)`` may store the states;
    ``resume`` takes them back and the fit goes on exactly as it would have.

    Small steps are made many to a job (``run_steps``), large ones a job each;
    both make the same steps.

    With ``local_steps`` H > 1 the fit is *local-step averaging*: in one pass
    (one job) every shard takes H gradient steps from the same weights, and
    the optimizer makes one step of H times the rate along the average of what
    the shards moved; for SGD that is the average of their weights.  H = 1 is
    the synchronous fit."""
    if len({(c.batch_size, c.workers, c.local_steps) for c in configs}) != 1:
        raise ValueError("fused trials must share batch_size, workers and local_steps")
    if configs[0].local_steps < 1:
        raise ValueError("local_steps must be positive")
    base = configs[0]
    own = feed is None
    feed = feed or FeedCache(train_df, val_df, key_col, feature_col, label_col)
    try:
        snap = feed.train(base.workers)
        val_snap = feed.val()
        if num_features is None:
            num_features = int(snap.df.select(F.size(feature_col)).first()[0])
        T, D, K = len(configs), num_features, num_classes
        steps = steps_per_epoch(sum(snap.shard_rows.values()), base.batch_size, base.workers)
        W = np.stack([init if init is not None else glorot(D, K, c.seed) for c in configs])
        opts = [Optimizer(c.optimizer, W[0].shape) for c in configs]
        plateaus = [Plateau(patience=c.plateau_patience) if c.plateau_patience else None for c in configs]
        active = np.ones(T, dtype=bool)
        stopped = [None] * T
        histories: list[list] = [[] for _ in range(T)]
        for t, state in enumerate(resume or []):
            W[t] = state["weights"]
            opts[t].restore(state["optimizer"])
            histories[t] = [dict(h) for h in state["history"]]
            if plateaus[t] and state.get("plateau"):
                plateaus[t] = replace(plateaus[t], **state["plateau"])
            stopped[t] = state.get("stopped")
            active[t] = stopped[t] is None
        drops = np.array([c.dropout for c in configs])
        seeds = np.array([c.seed for c in configs])
        ids = np.array(trial_ids if trial_ids is not None else [0] * T)

        def states():
            return [{"weights": W[t].copy(), "optimizer": opts[t].state(), "history": list(histories[t]),
                     "plateau": {k: getattr(plateaus[t], k) for k in ("best", "wait", "scale")} if plateaus[t] else None,
                     "stopped": stopped[t]} for t in range(T)]

        def rate_of(c, plateau, frac):
            target = c.learning_rate * (c.workers if c.scale_lr else 1)
            lr = warmup_lr(target, c.workers, frac, c.warmup_epochs)
            return plateau.apply(lr) if plateau else lr

        for epoch in range(start_epoch, max(c.epochs for c in configs)):
            for t, c in enumerate(configs):
                if epoch >= c.epochs:
                    active[t] = False
            if not active.any():
                break
            tr_loss, tr_corr, lrs = np.zeros(T), np.zeros(T), np.zeros(T)
            tr_n = tr_known = 0
            live = np.flatnonzero(active)          # finished trials leave the pass
            run = steps_a_job(base.batch_size * len(snap.shard_rows), D) if base.local_steps == 1 else base.local_steps
            mine = [(configs[t], plateaus[t]) for t in live]

            def rate(i, s, mine=mine, epoch=epoch):
                return rate_of(*mine[i], epoch + s / steps)

            for s in range(0, steps, run):
                at = (epoch * steps + s) * base.batch_size
                count = min(run, steps - s)
                lrs[live] = [rate(i, s) for i in range(len(live))]
                if base.local_steps == 1 and run > 1:
                    W[live], after, loss, corr, nb, known = run_steps(
                        snap, at, base.batch_size, count, W[live], [opts[t] for t in live], rate, drops[live],
                        seeds[live], epoch, s, feature_col, label_col, key_col, trial_ids=ids[live])
                    for i, t in enumerate(live):
                        opts[t], lrs[t] = after[i], rate(i, s + count - 1)
                elif base.local_steps == 1:
                    batch = feed_step(snap, at, at + base.batch_size)
                    grad, loss, corr, nb, known = all_reduce(batch, W[live], drops[live], seeds[live], epoch, s,
                                                             True, feature_col, label_col, key_col,
                                                             trial_ids=ids[live])
                else:
                    grad, loss, corr, nb, known = local_steps(snap, at, base.batch_size, count, W[live], lrs[live],
                                                              drops[live], seeds[live], epoch, s, feature_col,
                                                              label_col, key_col, trial_ids=ids[live])
                tr_loss[live] += loss
                tr_corr[live] += corr
                tr_n += nb
                tr_known += known
                if known == 0 or (base.local_steps == 1 and run > 1):
                    continue
                for g, t in zip(grad, live):
                    W[t] = opts[t].update(W[t], g / known, lrs[t] * count)
            vl = va = None
            if val_snap is not None:
                _, vloss, vcorr, vn, vknown = all_reduce(val_snap.df, W[live], drops[live], seeds[live], epoch,
                                                         -1, False, feature_col, label_col, key_col,
                                                         trial_ids=ids[live])
                vl, va = np.zeros(T), np.zeros(T)
                vl[live] = vloss / max(vknown, 1)
                va[live] = vcorr / max(vn, 1)
            for t in live:
                c = configs[t]
                h = {"epoch": epoch, "loss": float(tr_loss[t] / max(tr_known, 1)),
                     "accuracy": float(tr_corr[t] / max(tr_n, 1)), "lr": float(lrs[t]),
                     "steps": steps, "rows": tr_n}
                if tr_known < tr_n:
                    h["unknown_rows"] = tr_n - tr_known
                if vl is not None:
                    h["val_loss"] = float(vl[t])
                    h["val_accuracy"] = float(va[t])
                    if vknown < vn:
                        h["val_unknown_rows"] = vn - vknown
                histories[t].append(h)
                monitor = h.get("val_loss", h["loss"])
                if plateaus[t]:
                    plateaus[t].observe(monitor)
                if c.early_stop_patience:
                    stop = early_stop_epoch([x.get("val_loss", x["loss"]) for x in histories[t]],
                                            c.early_stop_patience, c.early_stop_min_delta)
                    if stop is not None:
                        active[t] = False
                        stopped[t] = epoch
            if on_epoch is not None:
                on_epoch(epoch, W, histories, states())
    finally:
        if own:
            feed.release()
    return [FitResult(weights=W[t, :D].copy(), bias=W[t, D].copy(), history=histories[t],
                      config=configs[t], steps_per_epoch=steps, stopped_epoch=stopped[t])
            for t in range(T)]


def fit(train_df: DataFrame, val_df: DataFrame | None, num_classes: int,
        config: TrainConfig | None = None, **kw) -> FitResult:
    """Data-parallel fit of one softmax head; an active run (``runs``) logs it."""
    result = fit_many(train_df, val_df, num_classes, [config or TrainConfig()], **kw)[0]
    log_fit(result)
    return result


def gradient_frame(df: DataFrame, weights: np.ndarray, dropout: float = 0.0, seed: int = 0,
                   feature_col: str = "features", label_col: str = "label_idx",
                   key_col: str = "row_id") -> DataFrame:
    """The all-reduce as a lazy DataFrame: mean gradient cells (k, pos, grad)
    of trial 0 for a (1, D+1, K) weight stack; pos = D is the bias."""
    w = np.array(weights, dtype=np.float64)
    d = np.array([dropout], dtype=np.float64)

    def fn(it):
        return partial_sums(it, w, d, seed, 0, 0, True, feature_col, label_col, key_col)

    sums = (df.select(key_col, feature_col, label_col).mapInPandas(fn, PARTIAL_SCHEMA)
              .groupBy("t", "k", "pos").agg(F.sum("g").alias("g")))
    # The row count travels with the sums; a window over this model-sized
    # table (not the data) spreads it to every cell.
    n = F.max(F.when(F.col("pos") == POS_COUNT, F.col("g"))).over(Window.partitionBy("t"))
    return (sums.withColumn("_n", n).filter(F.col("pos") >= 0)
                .select("k", "pos", (F.col("g") / F.col("_n")).alias("grad")))


def gradient(df: DataFrame, weights: np.ndarray, bias: np.ndarray | None = None,
             feature_col: str = "features", label_col: str = "label_idx",
             key_col: str = "row_id") -> tuple[np.ndarray, float, int]:
    """Mean gradient of the cross-entropy over a whole table (no dropout).
    Returns (grad (D+1, K) with the bias row last, mean loss, n)."""
    D, K = weights.shape
    W = np.zeros((1, D + 1, K))
    W[0, :D] = weights
    if bias is not None:
        W[0, D] = bias
    g, loss, _, n, known = all_reduce(df, W, np.zeros(1), 0, 0, 0, True, feature_col, label_col, key_col)
    return g[0] / max(known, 1), float(loss[0] / max(known, 1)), n


def evaluate(df: DataFrame, weights: np.ndarray, bias: np.ndarray,
             feature_col: str = "features", label_col: str = "label_idx",
             key_col: str = "row_id") -> dict:
    """Loss and accuracy of a head over a whole table (M10 / M11).  Rows of a
    class the head doesn't have are misses without a loss; ``unknown`` says
    how many there are."""
    D, K = weights.shape
    W = np.zeros((1, D + 1, K))
    W[0, :D], W[0, D] = weights, bias
    _, loss, corr, n, known = all_reduce(df, W, np.zeros(1), 0, 0, -1, False, feature_col, label_col, key_col)
    found = {"loss": float(loss[0] / max(known, 1)), "accuracy": float(corr[0] / max(n, 1)), "n": n,
             "unknown": n - known}
    log_evaluation(found)
    return found


def fit_full_batch(train_df: DataFrame, num_classes: int, feature_col: str = "features",
                   label_col: str = "label_idx", max_iter: int = 100, reg: float = 0.0) -> FitResult:
    """Reference convex fit with Spark MLlib (L-BFGS, multinomial), used to
    check the distributed trainer: same objective, no dropout."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = train_df.select(array_to_vector(F.col(feature_col)).alias("fv"),
                           F.col(label_col).cast("double").alias("y"))
    lr = LogisticRegression(featuresCol="fv", labelCol="y", family="multinomial",
                            maxIter=max_iter, regParam=reg, standardization=False)
    model = lr.fit(data)
    coef = model.coefficientMatrix.toArray()          # (K', D)
    icpt = model.interceptVector.toArray()
    k_fit = coef.shape[0]
    W = np.zeros((coef.shape[1], num_classes))
    b = np.zeros(num_classes)
    W[:, :k_fit] = coef.T
    b[:k_fit] = icpt
    if k_fit < num_classes:
        b[k_fit:] = -1e9
    summ = model.summary
    return FitResult(weights=W, bias=b, history=[{"epoch": i, "loss": float(v)} for i, v in
                                                 enumerate(summ.objectiveHistory)],
                     config=None, steps_per_epoch=1)
