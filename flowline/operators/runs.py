"""Runs, parameters, metrics, model versions and stages as ordinary tables.

Tables (append-only Parquet under one root):

    runs(run_id, parent_run_id, name, started_at, status)   a RUNNING row at
                                                  the start, one more at the end
    run_params(run_id, key, value)                 value as string
    run_metrics(run_id, key, step, value)          value as double
    run_tags(run_id, key, value)                   value as string
    registrations(name, run_id, registered_at, version)
    stage_events(name, version, stage, ts, seq)

A version number is fixed when it is given: the store claims it by creating a
file of that number, which only one writer can do, so neither a second writer
nor a registration with an older time moves it.  Stage events take their
sequence numbers in the same way.  A writer that is lost between its claim and
its row leaves a gap in the numbers, nothing else.

The query side is plain DataFrame operators that work on any tables of those
shapes; nothing is kept in a server.  Where a group can be hot (one parent
run with most children, one model name with most versions) the operators use
aggregates or the distributed ``row_index`` rather than a window that would
put the group in one task.
"""

from __future__ import annotations

import datetime as _dt
import re
import threading
import uuid
import warnings
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.operators.ranking import row_index
from flowline.session import scratch_path

# Appends to one folder share a staging folder: threads take turns.
_APPEND = threading.Lock()

RUNS = "run_id string, parent_run_id string, name string, started_at timestamp, status string"
PARAMS = "run_id string, key string, value string"
METRICS = "run_id string, key string, step bigint, value double"
TAGS = "run_id string, key string, value string"
REGS = "name string, run_id string, registered_at timestamp, version bigint"
STAGES = "name string, version bigint, stage string, ts timestamp, seq bigint"


# =========================================================== DataFrame operators
def wide_runs(runs: DataFrame, params: DataFrame | None, metrics: DataFrame | None,
              param_keys: list[str] = (), metric_keys: list[str] = (),
              run: str = "run_id") -> DataFrame:
    """One row per run, one column per parameter and per final metric value.
    Pivot keys are given explicitly (no extra job to discover them)."""
    out = runs
    if params is not None and param_keys:
        p = params.groupBy(run).pivot("key", list(param_keys)).agg(F.first("value"))
        out = out.join(p, run, "left")
    if metrics is not None and metric_keys:
        # last value per key in ONE aggregation (one shuffle on the run id):
        # max_by ignores rows whose ordering value is null, so each key only
        # sees its own rows
        m = metrics.groupBy(run).agg(*[
            F.max_by(F.when(F.col("key") == k, F.col("value")),
                     F.when(F.col("key") == k, F.col("step"))).alias(k)
            for k in metric_keys])
        out = out.join(m, run, "left")
    return out


def filter_children(runs: DataFrame, parent_run_id) -> DataFrame:
    """Runs whose parent is ``parent_run_id`` (tag filter)."""
    return runs.filter(F.col("parent_run_id") == F.lit(parent_run_id))


def child_runs(runs: DataFrame, run: str = "run_id", parent: str = "parent_run_id",
               cols: list[str] = ()) -> DataFrame:
    """Children joined to their parent run (one-to-many): a plain self-join;
    AQE splits a hot parent."""
    parents = runs.select(F.col(run).alias("_prun"), *[F.col(c).alias(f"parent_{c}") for c in cols])
    children = runs.where(F.col(parent).isNotNull())
    return children.join(parents, F.col(parent) == F.col("_prun")).drop("_prun")


LOWER, HIGHER = ("loss", "error", "rmse", "mse", "mae"), ("accuracy", "acc", "auc", "f1", "precision", "recall", "r2", "score")


def direction_known(metric: str) -> bool:
    return any(w in metric.lower() for w in LOWER + HIGHER)


def lower_is_better(metric: str) -> bool:
    """Losses and errors are minimised, every other metric maximised.  A name
    that says neither is warned of: give the direction."""
    if not direction_known(metric):
        warnings.warn(f"it isn't known whether {metric!r} should be low or high; taking high as better, "
                      "say ascending=True or False", stacklevel=3)
    return any(w in metric.lower() for w in LOWER)


# ------------------------------------------------------------ conditions on runs
# A key of a run in a condition or an order: kind.name or kind.`any name`;
# quoted text stands before it, so that nothing inside is taken for a key.
_KEY = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|\b(metrics|params|tags|attributes)\.(`[^`]+`|[A-Za-z_][\w.]*)""")
_ORDER = re.compile(r"(?is)^\s*(.*?)(?:\s+(asc|desc))?\s*$")


def _keys(text: str) -> set[tuple[str, str]]:
    return {(m[2], m[3].strip("`")) for m in _KEY.finditer(text) if m[2]}


def _compiled(text: str) -> str:
    """The text with keys as columns; the rest is Spark SQL as it stands."""
    return _KEY.sub(lambda m: m[1] if m[1] else f"`{m[2]}.{m[3].strip('`')}`", text)


def select_runs(runs: DataFrame, params: DataFrame | None = None, metrics: DataFrame | None = None,
                tags: DataFrame | None = None, where: str | None = None, order_by: Sequence[str] = (),
                show: Sequence[str] = (), run: str = "run_id") -> DataFrame:
    """The runs that meet a condition, in the order of several keys.

    Keys are ``metrics.m`` (a run's last value of m), ``params.p`` and
    ``tags.t`` (text) and ``attributes.c`` (a column of ``runs``); a name with
    other characters goes between backticks.  ``where`` is a Spark SQL
    condition on keys (``tags.team = 'a' AND (metrics.loss < 0.2 OR params.opt
    LIKE 'Ad%')``); ``order_by`` are keys or expressions with ASC or DESC,
    nulls last, then the run.  Only named keys are pivoted, in one aggregate a
    table; they come back as columns of that name (those of ``show`` too)."""
    named = sorted({k for text in (*([where] if where else []), *order_by, *show) for k in _keys(text)})
    out = runs
    for kind, key in named:
        if kind == "attributes":
            if key not in runs.columns:
                raise ValueError(f"runs have no attribute {key!r}")
            out = out.withColumn(f"attributes.{key}", F.col(key))
    for kind, table, step in (("params", params, None), ("tags", tags, None), ("metrics", metrics, "step")):
        keys = [k for name, k in named if name == kind]
        if not keys:
            continue
        if table is None:
            raise ValueError(f"no table of {kind}")
        values = table.filter(F.col("key").isin(keys)).groupBy(run).agg(*[
            (F.max_by(F.when(F.col("key") == k, F.col("value")), F.when(F.col("key") == k, F.col(step))) if step
             else F.max(F.when(F.col("key") == k, F.col("value")))).alias(f"{kind}.{k}") for k in keys])
        out = out.join(values, run, "left")
    if where:
        out = out.filter(F.expr(_compiled(where)))
    if order_by:
        order = []
        for text in order_by:
            by, way = _ORDER.match(text).groups()
            column = F.expr(_compiled(by))
            order.append(column.desc_nulls_last() if (way or "").lower() == "desc" else column.asc_nulls_last())
        out = out.orderBy(*order, F.col(run))
    return out


def latest_status(runs: DataFrame) -> DataFrame:
    """One row per run: its start, and the status it ended with, if it has
    (RUNNING until then)."""
    done = F.when(F.col("status") != "RUNNING", F.col("status"))
    return (runs.groupBy("run_id")
            .agg(F.first("parent_run_id", True).alias("parent_run_id"), F.first("name", True).alias("name"),
                 F.min("started_at").alias("started_at"), F.coalesce(F.max(done), F.lit("RUNNING")).alias("status")))


def rank_runs(wide: DataFrame, metric: str, group: str = "parent_run_id",
              run: str = "run_id", out: str = "rank", ascending: bool | None = None) -> DataFrame:
    """Order runs by ``metric`` (the best first: smallest for losses unless
    ``ascending`` says otherwise; nulls last), ties by run id, and number them
    from 1 inside each group -- distributed, skew-safe."""
    up = lower_is_better(metric) if ascending is None else ascending
    first = F.col(metric).asc_nulls_last() if up else F.col(metric).desc_nulls_last()
    ranked = row_index(wide, [first, F.col(run).asc()], [group], out="_r")
    return ranked.withColumn(out, F.col("_r") + 1).drop("_r")


def top_runs(wide: DataFrame, metric: str, group: str = "parent_run_id",
             run: str = "run_id", ascending: bool | None = None) -> DataFrame:
    """Best run per group by ``metric`` (see ``rank_runs``), nulls last, then
    run id -- an aggregate (partial per task), not a sort."""
    up = lower_is_better(metric) if ascending is None else ascending
    value = F.col(metric) if up else -F.col(metric)
    key = F.struct(F.col(metric).isNull().alias("n"), value.alias("m"), F.col(run).alias("r"))
    return wide.groupBy(group).agg(F.min_by(F.col(run), key).alias(run),
                                   F.min_by(F.col(metric), key).alias(metric))


def require_metric(wide: DataFrame, metric: str) -> None:
    if metric not in wide.columns or wide.where(F.col(metric).isNotNull()).limit(1).count() == 0:
        raise ValueError(f"no run has metric {metric!r}")


def model_versions(registrations: DataFrame, name: str = "name", run: str = "run_id",
                   at: str = "registered_at") -> DataFrame:
    """Version numbers 1, 2, ... per model name in registration order."""
    v = row_index(registrations, [at, run], [name], out="_v")
    return v.withColumn("version", F.col("_v") + 1).drop("_v")


def current_stages(stage_events: DataFrame) -> DataFrame:
    """Latest stage of every (name, version): the newest event wins, ties by
    sequence number."""
    return stage_events.groupBy("name", "version").agg(
        F.max_by("stage", F.struct("ts", "seq")).alias("stage"))


def version_in_stage(current: DataFrame, stage: str = "production") -> DataFrame:
    """Per model name, the highest version whose current stage is ``stage``
    (case-insensitive)."""
    return (current.filter(F.lower("stage") == stage.lower())
                   .groupBy("name").agg(F.max("version").alias("version")))


# =========================================================== the store
_ACTIVE: ContextVar = ContextVar("active run", default=None)


def log_fit(fit) -> None:
    """A fit's configuration, history and head (classes by number), if a run is active."""
    if _ACTIVE.get() is not None:
        from flowline.operators.infer import PackagedModel
        store, run_id = _ACTIVE.get()
        store.log_params(run_id, fit.config.params())
        store.log_history(run_id, fit.history)
        store.log_model(run_id, PackagedModel(fit.weights, fit.bias, [str(k) for k in range(len(fit.bias))]))


def log_evaluation(found: dict) -> None:
    """An evaluation's figures, prefixed ``eval_``, if a run is active."""
    if _ACTIVE.get() is not None:
        store, run_id = _ACTIVE.get()
        store.log_metrics(run_id, {f"eval_{k}": v for k, v in found.items()})


class RunStore:
    """Append-only run tables under ``root`` (the shared checkpoint folder by
    default).  Metadata rows are few and built on the driver; a run is there
    as RUNNING from its start, and its parameters and metrics are written once
    when it ends (not one write per key)."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or scratch_path(spark, "runs")
        self._open: dict = {}

    def _path(self, t: str) -> str:
        return f"{self.root}/{t}"

    def _append(self, t: str, rows: list, schema: str) -> None:
        if rows:
            with _APPEND:
                self.spark.createDataFrame(rows, schema).write.mode("append").parquet(self._path(t))

    def table(self, t: str) -> DataFrame:
        schema = {"runs": RUNS, "run_params": PARAMS, "run_metrics": METRICS, "run_tags": TAGS,
                  "registrations": REGS, "stage_events": STAGES}[t]
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._path(t))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)      # nothing written yet
        rows = self.spark.read.schema(schema).parquet(self._path(t))
        return latest_status(rows).select("run_id", "parent_run_id", "name", "started_at", "status") \
            if t == "runs" else rows

    # ------------------------------------------------------------ runs
    def start_run(self, name: str, parent_run_id: str | None = None) -> str:
        run_id = uuid.uuid4().hex
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self._open[run_id] = {"name": name, "parent": parent_run_id, "started": now, "params": {}, "metrics": [], "tags": {}}
        self._append("runs", [(run_id, parent_run_id, name, now, "RUNNING")], RUNS)
        return run_id

    @contextmanager
    def run(self, name: str, parent_run_id: str | None = None):
        """A run that ends as FINISHED, or as FAILED if its body raises."""
        run_id = self.start_run(name, parent_run_id)
        try:
            yield run_id
        except BaseException:
            self.end_run(run_id, "FAILED")
            raise
        self.end_run(run_id)

    @contextmanager
    def active_run(self, name: str, parent_run_id: str | None = None):
        """As ``run``; besides, every ``trainer.fit`` and ``trainer.evaluate``
        inside logs to it by itself (this thread's context; nested ones log to
        the innermost)."""
        with self.run(name, parent_run_id) as run_id:
            token = _ACTIVE.set((self, run_id))
            try:
                yield run_id
            finally:
                _ACTIVE.reset(token)

    def log_params(self, run_id: str, params: dict) -> None:
        self._open[run_id]["params"].update({k: str(v) for k, v in params.items()})

    def set_tags(self, run_id: str, tags: dict) -> None:
        self._open[run_id]["tags"].update({k: str(v) for k, v in tags.items()})

    def log_metrics(self, run_id: str, metrics: dict, step: int = 0) -> None:
        self._open[run_id]["metrics"] += [(k, int(step), float(v)) for k, v in metrics.items()
                                          if v is not None]

    def log_history(self, run_id: str, history: list, keys=("loss", "accuracy", "val_loss", "val_accuracy")) -> None:
        for h in history:
            self.log_metrics(run_id, {k: h[k] for k in keys if k in h}, step=h.get("epoch", 0))

    def end_run(self, run_id: str, status: str = "FINISHED") -> None:
        r = self._open.pop(run_id)
        self._append("runs", [(run_id, r["parent"], r["name"], r["started"], status)], RUNS)
        self._append("run_params", [(run_id, k, v) for k, v in r["params"].items()], PARAMS)
        self._append("run_metrics", [(run_id, k, s, v) for k, s, v in r["metrics"]], METRICS)
        self._append("run_tags", [(run_id, k, v) for k, v in r["tags"].items()], TAGS)

    def find_runs(self, where: str | None = None, order_by: Sequence[str] = (), show: Sequence[str] = ()) -> DataFrame:
        """``select_runs`` over the store's tables."""
        return select_runs(self.table("runs"), self.table("run_params"), self.table("run_metrics"),
                           self.table("run_tags"), where, order_by, show)

    def search_runs(self, parent_run_id: str | None = None, metric: str = "val_accuracy",
                    param_keys: list[str] = (), metric_keys: list[str] = ("val_loss", "val_accuracy"),
                    ascending: bool | None = None) -> DataFrame:
        """Runs with their parameters and metrics, the best by ``metric`` first
        (the smallest for losses, unless ``ascending`` says otherwise)."""
        runs = self.table("runs")
        if parent_run_id is not None:
            runs = filter_children(runs, parent_run_id)
        wide = wide_runs(runs, self.table("run_params"), self.table("run_metrics"),
                         list(param_keys), list(metric_keys))
        require_metric(wide, metric)
        up = lower_is_better(metric) if ascending is None else ascending
        return wide.orderBy(F.col(metric).asc_nulls_last() if up else F.col(metric).desc_nulls_last(), F.col("run_id"))

    # ------------------------------------------------------------ artifacts
    def log_model(self, run_id: str, model) -> str:
        """Store a ``PackagedModel`` (head, vocabulary, preprocessing config)
        under the run."""
        path = f"{self.root}/models/{run_id}"
        model.save(self.spark, path, run_id)
        return path

    def load_model(self, run_id: str):
        from flowline.operators.infer import PackagedModel
        return PackagedModel.load(self.spark, f"{self.root}/models/{run_id}", run_id)

    def load_by_stage(self, name: str, stage: str = "production"):
        rid = self.run_for_stage(name, stage)
        if rid is None:
            raise KeyError(f"no version of {name!r} in stage {stage!r}")
        return self.load_model(rid)

    # ------------------------------------------------------------ registry
    def register_model(self, name: str, run_id: str, registered_at: _dt.datetime | None = None) -> int:
        return self.register_models([(name, run_id)], registered_at)[0]

    def register_models(self, models: Sequence[tuple[str, str]], registered_at: _dt.datetime | None = None) -> list[int]:
        """Claim the next version of each (name, run) in turn, and write all
        their rows at once."""
        at = registered_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rows = [(name, run_id, at, claim_next(self.spark, f"{self._path('versions')}/{_folder(name)}"))
                for name, run_id in models]
        self._append("registrations", rows, REGS)
        return [r[3] for r in rows]

    def transition_stage(self, name: str, version: int, stage: str) -> None:
        seq = claim_next(self.spark, self._path("stage_numbers"))
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self._append("stage_events", [(name, int(version), stage, now, int(seq))], STAGES)

    def run_for_stage(self, name: str, stage: str = "production") -> str | None:
        cur = current_stages(self.table("stage_events").filter(F.col("name") == name))
        best = version_in_stage(cur, stage).first()
        if best is None:
            return None
        row = (self.table("registrations").filter((F.col("name") == name) & (F.col("version") == best.version))
               .select("run_id").first())
        return row.run_id if row else None


def _folder(name: str) -> str:
    """A model name as a folder's name, one to one."""
    return quote(name, safe="") or "%"


def claim_next(spark: SparkSession, folder: str) -> int:
    """The next number of ``folder``, ours alone: the file of that number is
    created if it isn't there, and the number after it is tried if it is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    fs.mkdirs(path)
    number = max((int(f.getPath().getName()) for f in fs.listStatus(path) if f.getPath().getName().isdigit()), default=0)
    while True:
        number += 1
        if _created(jvm, fs, jvm.org.apache.hadoop.fs.Path(path, str(number))):
            return number


def _created(jvm, fs, path) -> bool:
    """Create an empty file unless there is one, in one step: distributed
    stores refuse to create what exists; Hadoop's local file system looks
    first and creates then, so a local folder goes by the JVM's own call."""
    try:
        if fs.getUri().getScheme() == "file":
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(path.toUri().getPath()).toPath(), _no_attributes(jvm))
        else:
            fs.create(path, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def _no_attributes(jvm):
    from pyspark import SparkContext
    return SparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
