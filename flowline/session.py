"""Session construction and the shared scratch location.

Everything that needs durable intermediate storage (training snapshots,
weight checkpoints, cut lineage) goes under the folder the cluster names in
``spark.checkpoint.dir``.  We read it from the session and only fall back to a
folder of our own when it is unset (tests on a laptop).
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings that matter for correctness and for scale; anything the cluster
# already set is left alone by ``builder``.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to Python workers: capped by rows AND bytes, so decoded
    # image rows (~150 KB each) stay near 32 MB per batch while narrow
    # feature rows still travel 1024 at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "flowline",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint root, setting one only where none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        # a machine-local folder serves one machine only
        if not fallback and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        conf_dir = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"),
                                            "flowline-checkpoints")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint root (never machine-local)."""
    root = ensure_checkpoint_dir(spark)
    return "/".join([root.rstrip("/"), "flowline", *parts, uuid.uuid4().hex])


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``flowline`` importable in executors' Python workers, as
    ``--py-files`` would.  The zip is built in memory and written through
    the Hadoop FileSystem API into the shared checkpoint folder (no
    machine-local temporary folder), then added with ``addPyFile``."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = scratch_path(spark, "pyfiles") + "/flowline.zip"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(key)
