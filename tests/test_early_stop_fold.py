import random

from flowline.operators.trainer import early_stop_epoch
from flowline.plans.catalog import early_stop_fold


def test_spark_fold_equals_python_rule(spark):
    rnd = random.Random(3)
    rows, expect = [], {}
    for run in range(20):
        vals = [1.0]
        for _ in range(14):
            vals.append(vals[-1] + rnd.choice([-0.05, -0.005, 0.0, 0.02]))
        for e, v in enumerate(vals):
            rows.append((f"r{run}", e, v))
        expect[f"r{run}"] = early_stop_epoch(vals, 3, 0.01)
    df = spark.createDataFrame(rows, "run string, epoch int, val_loss double")
    got = {r.run: r.stop_epoch for r in early_stop_fold(df, 3, 0.01).collect()}
    assert got == expect
