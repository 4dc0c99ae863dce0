import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from flowline.functions import columns as C


def test_label_from_path(spark):
    df = spark.createDataFrame([("/data/images/class_b/1.jpg",), ("x.jpg",), ("a/b",)], "p string")
    got = [r.l for r in df.select(C.label_from_path("p").alias("l")).collect()]
    assert got == ["class_b", None, "a"]


def test_safe_identifier_and_path_join(spark):
    df = spark.createDataFrame([("first.last@example.com",)], "a string")
    r = df.select(C.safe_identifier("a").alias("i"),
                  C.path_join(F.lit("/ckpt"), C.safe_identifier("a"), F.lit("x")).alias("p")).first()
    assert r.i == "first_last" and r.p == "/ckpt/first_last/x"


def test_hash_unit_matches_python_md5(spark):
    df = spark.range(50)
    got = {r.id: r.u for r in df.select("id", C.hash_unit("id", "s").alias("u")).collect()}
    for i, u in got.items():
        exp = int(hashlib.md5(f"s{i}".encode()).hexdigest()[:8], 16) / 2 ** 32
        assert u == exp


def test_argmax_softmax_logsumexp(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, -2.0],), ([1000.0, 1000.0],)], "a array<double>")
    rows = df.select(C.array_argmax("a").alias("i"), C.softmax("a").alias("p"),
                     C.logsumexp("a").alias("l"), "a").collect()
    for r in rows:
        a = np.array(r.a)
        assert r.i == int(np.argmax(a))          # first maximum, like numpy
        assert abs(sum(r.p) - 1) < 1e-12
        m = a.max()
        assert abs(r.l - (m + math.log(np.exp(a - m).sum()))) < 1e-9


def test_warmup_schedule(spark):
    df = spark.createDataFrame([(0.0,), (2.5,), (5.0,), (7.0,)], "e double")
    got = [r.lr for r in df.select(C.warmup_lr(F.lit(0.004), F.lit(4), "e", 5).alias("lr")).collect()]
    assert got[0] == 0.001 and got[2] == 0.004 and got[3] == 0.004
    assert abs(got[1] - 0.001 * (1 + 2.5 * 3 / 5)) < 1e-15


def test_pixel_scale(spark):
    df = spark.createDataFrame([([0.0, 127.5, 255.0],)], "a array<double>")
    assert df.select(C.pixel_scale("a").alias("s")).first().s == [-1.0, 0.0, 1.0]
