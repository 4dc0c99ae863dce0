"""Token ids written as compressed bit planes, and read back.

Documents are range-partitioned by doc_id and sorted, so that partition after
partition holds them in ascending order; each partition is a *shard*.  The ids
of a shard are cut into blocks of ``BLOCK``; a block is transposed into bit
planes (or byte planes), each plane is compressed with zstandard, and the
planes form one payload (format below).  The chunk index names for every
block its shard, number, first id, count and the documents in it.  Payloads
and index are the columns of one Parquet dataset: Spark's committer makes the
write safe against lost tasks, on any store.

Payload, little-endian: ``BPL1``, u8 bits per plane unit (1 or 8), u8 planes,
u16 zero, u32 ids, u32 size of each plane, then the planes, lowest first.

Reading decodes each block where it lies.  A document in several blocks is
put together from per-block CRC-32 values, not from its ids.

Encoding: texts are cut before single spaces between characters that aren't
white space.  No token of a byte-level BPE with the usual word pattern spans
such a cut, so the pieces' ids in a row are the text's ids; pieces that a
worker has seen are looked up, unseen ones are encoded many to a text and cut
apart where their bytes end (if a token does not end there, one by one).

Nulls and ties: a null text is empty (the end id alone); a null doc_id sorts
first; rows of one doc_id are ordered by the hash of their text, and each
gets its own row.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowline.llm.common import portions, ranges, releasing, table

BLOCK = 65_536
END_ID = 0
MAGIC = b"BPL1"
CACHE = 500_000          # pieces in each of the two generations of a worker's cache
JOINED = 512             # unseen pieces encoded as one text
SPACES = re.compile(r"\s\s")


# ---------------------------------------------------------------- format

def pack_block(ids: np.ndarray, unit: int = 1, level: int = 3) -> bytes:
    """The payload of a block of ids; ``unit`` 1 for bit, 8 for byte planes."""
    ids = np.ascontiguousarray(ids, np.uint32)
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    most = int(ids.max(initial=0)).bit_length()
    if unit == 8:
        planes = [np.ascontiguousarray(raw[:, k]) for k in range(max(1, -(-most // 8)))]
    else:
        planes = [np.packbits(((ids >> np.uint32(k)) & np.uint32(1)).astype(np.uint8)) for k in range(max(1, most))]
    z = zstandard.ZstdCompressor(level=level)
    done = [z.compress(p.tobytes()) for p in planes]
    return (MAGIC + struct.pack("<BBHI", unit, len(done), 0, len(ids))
            + struct.pack(f"<{len(done)}I", *map(len, done)) + b"".join(done))


def unpack_block(payload: bytes) -> np.ndarray:
    """The ids (uint32) of a payload."""
    if payload[:4] != MAGIC:
        raise ValueError("not a bit-plane block")
    unit, planes, _, n = struct.unpack_from("<BBHI", payload, 4)
    sizes = struct.unpack_from(f"<{planes}I", payload, 12)
    z, at = zstandard.ZstdDecompressor(), 12 + 4 * planes
    out = np.zeros(n, np.uint32)
    for k, size in enumerate(sizes):
        raw = np.frombuffer(z.decompress(payload[at:at + size]), np.uint8)
        at += size
        bits = raw if unit == 8 else np.unpackbits(raw, count=n)
        out |= bits.astype(np.uint32) << np.uint32(k * unit)
    return out


# ---------------------------------------------------------------- CRC-32

def _times(m: list[int], v: int) -> int:
    out, k = 0, 0
    while v:
        if v & 1:
            out ^= m[k]
        v, k = v >> 1, k + 1
    return out


def _zero_byte() -> list[int]:
    m = [0xEDB88320] + [1 << k for k in range(31)]           # one zero bit
    for _ in range(3):
        m = [_times(m, x) for x in m]
    return m


_POWERS = [_zero_byte()]                                     # 2**k zero bytes


def crc32_join(first: int, second: int, length: int) -> int:
    """CRC-32 of two byte strings in a row from theirs; ``length`` is that of
    the second."""
    k = 0
    while length:
        if len(_POWERS) <= k:
            _POWERS.append([_times(_POWERS[-1], x) for x in _POWERS[-1]])
        if length & 1:
            first = _times(_POWERS[k], first)
        length, k = length >> 1, k + 1
    return first ^ second


# ---------------------------------------------------------------- encoding

def pieces(text: str) -> list[str]:
    """The text cut before each single space between two characters that
    aren't white space."""
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        before = out[-1]
        if p and before and not p[0].isspace() and not before[-1].isspace():
            out.append(" " + p)
        else:
            out[-1] = f"{before} {p}"
    return out


class Known:
    """One generation of the cache: the rows of pieces by their text, with
    their ids (all in a row, where each begins, how many)."""

    def __init__(self):
        self.row: dict[str, int] = {}
        self.ids, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, some: list[str], ids: list[np.ndarray], size: list[np.ndarray]) -> None:
        """New pieces: their ids in order, and how many each has."""
        self.row.update(zip(some, range(len(self.row), len(self.row) + len(some))))
        more = np.concatenate(size)
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(more) - more])
        self.ids, self.size = np.concatenate([self.ids, *ids]), np.concatenate([self.size, more])

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows, and how many each has."""
        return self.ids[ranges(self.begin[rows], self.size[rows])], self.size[rows]


class Encoder:
    """Texts to the bytes of their ids (uint32), with a cache by piece."""

    _own: dict = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark runs one task a core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # bytes of each id's text: a character each in a byte-level vocabulary
        special = self.tokenizer.get_added_tokens_decoder()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for t, i in vocabulary.items():
            self.size[i] = len(t.encode("utf-8")) if i in special else len(t)
        self.new, self.old = Known(), Known()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The encoder of this worker process."""
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def cut(self, texts: list[str | None]) -> tuple[list[str], list[np.ndarray]]:
        """The pieces of the texts (some may be there twice), and the places of
        each text's own among them.  Texts without white space in a row are cut
        at every space, by Arrow."""
        single = [bool(t) and t[0] != " " != t[-1] and not SPACES.search(t) for t in texts]
        halves = [t.partition(" ") for t, s in zip(texts, single) if s]
        parts = pc.split_pattern(pa.array([after if space else None for _, space, after in halves], pa.large_string()), " ")
        found = parts.flatten().dictionary_encode()
        out = [" " + p for p in found.dictionary.to_numpy(zero_copy_only=False).tolist()]
        inner = iter(np.split(found.indices.to_numpy(), np.cumsum(pc.list_value_length(parts).fill_null(0).to_numpy())[:-1]))
        first = iter(halves)
        places = []
        for t, s in zip(texts, single):
            own = [next(first)[0]] if s else pieces(t) if t else []
            at = np.arange(len(out), len(out) + len(own))
            places.append(np.concatenate([at, next(inner)]) if s else at)
            out += own
        return out, places

    def rows(self, some: list[str]) -> np.ndarray:
        """The pieces' rows in the newer generation of the cache."""
        if len(self.new.row) >= CACHE:
            self.old, self.new = self.new, Known()
        rows = np.fromiter(map(self.new.row.get, some, itertools.repeat(-1)), np.int64, len(some))
        unseen = np.flatnonzero(rows < 0)
        names = [some[k] for k in unseen.tolist()]
        self.learn(set(names))
        rows[unseen] = np.fromiter(map(self.new.row.__getitem__, names), np.int64, len(names))
        return rows

    def learn(self, unseen: set[str]) -> None:
        """Put pieces that aren't there into the newer generation of the cache."""
        known = [p for p in unseen if p in self.old.row]
        if known:
            ids, size = self.old.of(np.array([self.old.row[p] for p in known]))
            self.new.add(known, [ids], [size])
        missing = unseen.difference(known)
        # pieces with their space in a row are a text that is cut at each of them
        rest = [p for p in missing if p[0] != " "]
        spaced = [p for p in missing if p[0] == " "]
        rows = [spaced[k:k + JOINED] for k in range(0, len(spaced), JOINED)]
        done, made, sizes = [], [], []
        for row, e in zip(rows, self.tokenizer.encode_batch_fast(["".join(row) for row in rows], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            ends, at_end = np.cumsum(self.size[ids]), np.cumsum([len(p.encode("utf-8")) for p in row])
            at = np.searchsorted(ends, at_end)
            if len(ids) == 0 or at[-1] != len(ids) - 1 or (ends[at] != at_end).any():
                rest += row                                  # a token spans two pieces: each by itself
                continue
            done += row
            made.append(ids)
            sizes.append(np.diff(at, prepend=-1))
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            done.append(p)
            made.append(np.array(e.ids, np.uint32))
            sizes.append(np.array([len(e.ids)]))
        if done:
            self.new.add(done, made, sizes)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out, places = self.cut(texts)
        rows = self.rows(out)
        return [self.new.of(rows[at])[0].tobytes() for at in places]


# ---------------------------------------------------------------- write, read

_WRITTEN = ("shard int, block int, first long, n_ids int, first_doc long, doc_ids array<long>, "
            "doc_lengths array<int>, payload binary")


def write_ids(docs: DataFrame, path: str, vocabulary: str, unit: int = 1, block: int = BLOCK) -> None:
    """Encode the documents and write the dataset at ``path``."""
    end = np.array([END_ID], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = Encoder.of(vocabulary), TaskContext.get().partitionId()
        held: deque = deque()                # (doc_id, id bytes) not yet written
        size = done = number = docs_done = 0

        def put(last: bool):
            nonlocal size, done, number, docs_done
            while size >= block or (last and size):
                n = left = min(block, size)
                first_doc, take = docs_done, []
                while left:
                    doc, raw = held.popleft()
                    part, rest = raw[:4 * left], raw[4 * left:]
                    take.append((doc, part))
                    left -= len(part) // 4
                    if rest:
                        held.appendleft((doc, rest))     # goes on in the next block
                    else:
                        docs_done += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([done], pa.int64()),
                     pa.array([n], pa.int32()), pa.array([first_doc], pa.int64()),
                     pa.array([[d for d, _ in take]], pa.list_(pa.int64())),
                     pa.array([[len(p) // 4 for _, p in take]], pa.list_(pa.int32())),
                     pa.array([pack_block(np.frombuffer(b"".join(p for _, p in take), np.uint32), unit)],
                              pa.binary())],
                    names=["shard", "block", "first", "n_ids", "first_doc", "doc_ids", "doc_lengths", "payload"])
                number, done, size = number + 1, done + n, size - n

        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for k, e in portions(texts):
                for doc, raw in zip(ids[k:e], coder.encode(texts[k:e])):
                    held.append((doc, raw + end))
                    size += len(raw) // 4 + 1
                yield from put(False)
        yield from put(True)

    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    with releasing(docs.sparkSession):
        rows.mapInArrow(run, _WRITTEN).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(shard, doc, doc_id, block, ids): the ids of each document's part in
    each block, ids as little-endian uint32 bytes; ``doc`` counts within the
    shard."""
    return _parts(spark.read.schema(_WRITTEN).parquet(path), whole=True)


def _parts(blocks: DataFrame, whole: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                raw, at = unpack_block(row["payload"]).astype("<u4").tobytes(), 0
                parts = []
                for n in row["doc_lengths"]:
                    parts.append(raw[4 * at:4 * (at + n)])
                    at += n
                k, lengths = len(parts), np.array(row["doc_lengths"], np.int64)
                content = pa.array(parts, pa.binary()) if whole else pa.array([zlib.crc32(p) for p in parts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * k, pa.int32()), pa.array(row["first_doc"] + np.arange(k), pa.int64()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array([row["block"]] * k, pa.int32()),
                     pa.array(row["first"] + np.cumsum(lengths) - lengths), pa.array(lengths), content],
                    names=["shard", "doc", "doc_id", "block", "at", "n", "content"])

    return blocks.mapInArrow(run, "shard int, doc long, doc_id long, block int, at long, n long, content "
                             + ("binary" if whole else "long"))


def _joined_crc(parts: pd.Series) -> pd.Series:
    out = []
    for row in parts:
        crc = 0
        for k, p in enumerate(row):
            crc = p["content"] if k == 0 else crc32_join(crc, p["content"], 4 * int(p["n"]))
        out.append(crc)
    return pd.Series(out, dtype="int64")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files."""
    blocks = spark.read.schema(_WRITTEN).parquet(path)
    # one row per shard
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = (blocks.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
            .select("shard", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("base")))
    docs = (_parts(blocks, whole=False).groupBy("shard", "doc")
            .agg(F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
                 F.sort_array(F.collect_list(F.struct("block", "n", "content"))).alias("parts")))
    return (docs.join(base, "shard")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens",
                    F.pandas_udf(_joined_crc, "long")("parts").alias("ids_crc32")))


def op7_bitplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` as ids in bit planes, written and read back."""
    import public_tokenizers

    from flowline.session import scratch_path
    path = scratch_path(spark, "llm", "token_ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return digest(spark, path)
