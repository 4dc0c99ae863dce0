"""Helpers shared by the operators: words and their hashes, staged tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from flowline.session import scratch_path

# A word is a run of characters other than ASCII white space.  ``bytes.split``
# cuts at exactly these six characters.
WORD_PATTERN = "[^ \\t\\n\\x0B\\f\\r]+"
SPACE_PATTERN = "[ \\t\\n\\x0B\\f\\r]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def releasing(spark: SparkSession):
    """Within it, a write lets go of its shuffle files when it has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    It cuts the lineage: a lost executor re-reads files instead of repeating
    the job.  The shuffle files of the write are released with it."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    with releasing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def portions(texts: list[str | None], chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs of texts of about ``chars`` characters (a longer
    text is a run of its own): what a worker holds cut into words at a time."""
    begin = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield begin, k + 1
            begin, size = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of each range, one range after the other."""
    out = np.repeat(begin - (np.cumsum(size) - size), size)
    out += np.arange(len(out))
    return out


def spelled(words: pa.Array, ids: np.ndarray, sizes: list[int]) -> list[bytes]:
    """The bytes of several runs of ids in a row, of ``sizes`` ids each, joined
    by Arrow; ``words`` (large_binary) has the bytes of each id."""
    said = words.take(pa.array(ids))
    if len(said) == 0:
        return [b""] * len(sizes)
    data = said.buffers()[2].to_pybytes() if said.buffers()[2] else b""
    ends = np.frombuffer(said.buffers()[1], "<i8")[np.cumsum([0, *sizes])].tolist()
    return [data[s:e] for s, e in zip(ends, ends[1:])]


def mix64(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive 64-bit hash of two uint64 arrays, element by element."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C159E3779B9))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """One uint64 per word of the text (null: none)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = (raw.lower() if lower else raw).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
