"""Property-based checks (hypothesis) of the invariants the operators rely on."""
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowline.operators import trainer as TR
from flowline.operators.ranking import row_index


@given(st.lists(st.floats(min_value=0, max_value=10, allow_nan=False), min_size=1, max_size=30),
       st.integers(min_value=1, max_value=5), st.floats(min_value=0, max_value=0.5))
def test_early_stop_is_a_prefix_decision(values, patience, min_delta):
    stop = TR.early_stop_epoch(values, patience, min_delta)
    if stop is not None:
        # the decision only depends on the prefix up to the stop epoch
        assert TR.early_stop_epoch(values[:stop + 1], patience, min_delta) == stop
        assert stop >= patience
    # a strictly improving series (by more than min_delta) never stops
    steady = [10.0 - i * (min_delta + 0.01) for i in range(len(values))]
    assert TR.early_stop_epoch(steady, patience, min_delta) is None


@given(st.integers(min_value=1, max_value=200), st.integers(min_value=1, max_value=64),
       st.floats(min_value=0.0, max_value=0.9))
def test_dropout_mask_rate_and_determinism(n, dim, rate):
    keys = np.arange(n) * 7919
    a = TR.dropout_keep(keys, dim, rate, 1, 0, 2, 3)
    assert a.shape == (n, dim)
    assert (a == TR.dropout_keep(keys, dim, rate, 1, 0, 2, 3)).all()
    if n * dim >= 2000:
        assert abs((1 - a.mean()) - rate) < 0.05


@given(st.lists(st.floats(min_value=-5, max_value=5), min_size=2, max_size=6),
       st.floats(min_value=1e-4, max_value=1.0))
def test_adam_first_step_is_bounded_by_lr(g0, lr):
    g = np.array([g0])
    w = np.zeros_like(g)
    step = TR.Optimizer("adam", w.shape).update(w, g, lr) - w
    assert (np.abs(step) <= lr * (1 + 1e-9)).all()
    big = np.abs(g) > 1e-3
    assert (np.sign(step[big]) == -np.sign(g[big])).all()


@settings(max_examples=4, deadline=None)
@given(st.integers(min_value=1, max_value=6), st.integers(min_value=1, max_value=9),
       st.integers(min_value=0, max_value=10_000))
def test_row_index_equals_row_number(spark, groups, partitions, seed):
    rng = np.random.default_rng(seed)
    n = 300
    g = rng.integers(0, groups, n)
    g[: n // 2] = 0                                      # one hot group
    rows = [(int(i), int(g[i]), float(rng.random())) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    expect = {r.id: r.i for r in df.select(
        "id", (F.row_number().over(Window.partitionBy("g").orderBy("v", "id")) - 1).alias("i")).collect()}
    got = {r.id: r.row_idx for r in row_index(df, ["v", "id"], ["g"], partitions=partitions).collect()}
    assert got == expect
