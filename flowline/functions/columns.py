"""Column-level functions.  Every function returns a ``Column`` built only from
``pyspark.sql.functions`` so that it stays inside the JVM (codegen, no Python
worker).  Array helpers use SQL higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- hashing
def hash_hex8(key, salt: str = "") -> Column:
    """First 8 hex digits of md5(salt || string(key)).  Portable: DuckDB and
    any other engine with md5 produce the same digits."""
    s = _c(key).cast("string")
    if salt:
        s = F.concat(F.lit(salt), s)
    return F.substring(F.md5(s), 1, 8)


def hash_u32(key, salt: str = "") -> Column:
    """Unsigned 32-bit integer from md5, as bigint in [0, 2^32)."""
    return F.conv(hash_hex8(key, salt), 16, 10).cast("bigint")


def hash_unit(key, salt: str = "") -> Column:
    """Deterministic uniform number in [0, 1) from a stable key."""
    return hash_u32(key, salt).cast("double") / F.lit(TWO_POW_32)


def hash_bucket(key, buckets: int, salt: str = "") -> Column:
    return F.pmod(hash_u32(key, salt), F.lit(buckets))


# ---------------------------------------------------------------- strings / paths
def label_from_path(path, depth: int = 2) -> Column:
    """Parent-directory name of a file path (``path.split('/')[-2]``); NULL for
    paths that are too short instead of an error."""
    return F.try_element_at(F.split(_c(path), "/"), F.lit(-depth))


def safe_identifier(account) -> Column:
    """``user@example.com`` -> ``user``; dots become underscores."""
    return F.replace(F.split_part(_c(account), F.lit("@"), F.lit(1)), F.lit("."), F.lit("_"))


def path_join(*parts) -> Column:
    return F.concat_ws("/", *[_c(p) for p in parts])


def param_string(**params) -> Column:
    """``learning_rate_<v>_dropout_<v>_...`` from named columns, in the order given."""
    pieces = []
    for name, c in params.items():
        pieces += [F.lit(name), _c(c).cast("string")]
    return F.concat_ws("_", *pieces)


# ---------------------------------------------------------------- arithmetic
def steps_per_epoch(n_rows, batch_size, workers=1, at_least_one: bool = True) -> Column:
    s = F.floor(_c(n_rows) / (_c(batch_size) * _c(workers)))
    return F.greatest(F.lit(1).cast("bigint"), s) if at_least_one else s


def scaled_lr(base_lr, workers) -> Column:
    """Linear learning-rate scaling by the number of workers."""
    return _c(base_lr) * _c(workers)


def warmup_lr(target_lr, workers, epoch, warmup_epochs: int = 5) -> Column:
    """Gradual warm-up: target/workers at epoch 0 rising linearly to target at
    ``warmup_epochs`` (``epoch`` may be fractional), then flat."""
    e = _c(epoch).cast("double")
    w = _c(workers).cast("double")
    ramp = _c(target_lr) / w * (F.lit(1.0) + e * (w - F.lit(1.0)) / F.lit(float(warmup_epochs)))
    return F.when(e < F.lit(float(warmup_epochs)), ramp).otherwise(_c(target_lr).cast("double"))


def negate(c) -> Column:
    return -_c(c)


# ---------------------------------------------------------------- arrays
def pixel_scale(arr) -> Column:
    """[0, 255] -> [-1, 1] (``x/127.5 - 1``)."""
    return F.transform(_c(arr), lambda x: x.cast("double") / F.lit(127.5) - F.lit(1.0))


def to_float_array(arr) -> Column:
    return _c(arr).cast("array<float>")


def array_argmax(arr) -> Column:
    """0-based index of the first maximum (numpy ``argmax``)."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - F.lit(1)).cast("int")


def array_sum(arr) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double"))


def logsumexp(arr) -> Column:
    a = _c(arr)
    m = F.array_max(a).cast("double")
    return m + F.log(F.aggregate(a, F.lit(0.0).cast("double"),
                                 lambda s, x: s + F.exp(x.cast("double") - m)))


def softmax(arr) -> Column:
    a = _c(arr)
    m = F.array_max(a).cast("double")
    e = F.transform(a, lambda x: F.exp(x.cast("double") - m))
    tot = F.aggregate(e, F.lit(0.0).cast("double"), lambda s, x: s + x)
    return F.transform(e, lambda x: x / tot)


def dot(arr, weights) -> Column:
    """Dot product of an array column with an equally long array (column or
    Python list of floats)."""
    w = F.array(*[F.lit(float(v)) for v in weights]) if isinstance(weights, (list, tuple)) else _c(weights)
    return F.aggregate(F.zip_with(_c(arr), w, lambda x, y: x.cast("double") * y),
                       F.lit(0.0).cast("double"), lambda s, v: s + v)


def cross_entropy(logits, label_idx) -> Column:
    """Per-row sparse categorical cross-entropy on logits."""
    return logsumexp(logits) - F.element_at(_c(logits), _c(label_idx) + F.lit(1)).cast("double")


def prefixed_metric_map(names: list[str], values: list, prefix: str = "val_") -> Column:
    m = F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                          F.array(*[_c(v).cast("double") for v in values]))
    return F.transform_keys(m, lambda k, v: F.concat(F.lit(prefix), k))
