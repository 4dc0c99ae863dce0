"""Substring dedup by level-wise doubling of word windows.

A window of ``length`` words can repeat only if every shorter window in it
repeats.  Levels start at ``start`` words and double (5, 10, 20).  At each
level below the last, each window of ``length`` words that is still alive is
tested through one sub-window of the level's length, its *minimizer* (the
sub-window with the smallest hash): equal windows have equal minimizers, so a
window whose minimizer stands alone in the corpus can't repeat.  That needs
one row for about eight windows.  Levels end when nothing survives.  At the
last level the surviving windows themselves are grouped, and all but the
first occurrence (smallest doc_id, then smallest start) go.

A hash of 2L words is made of the two hashes of its halves, so a level costs
one vectorised step.  Hot windows: each task first settles repeats among its
own rows, so a window found in a third of all documents sends one row a chunk.

Nulls and ties: a null or empty text has no words (kept_sha256 of "").  Rows
with a null ``doc_id`` are returned as they are and take no part.  Repeated
rows of one ``doc_id`` with one text start their windows at the same place,
which isn't earlier: none removes the other; a task reads them once, and a
position is kept once, however many rows hold it.  Texts of under ``length``
words stay whole; a text of any length is one chunk, in one task.  An empty
table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm.common import mix64, staged, table, word_hashes

LENGTH = 20
START = 5
CHUNK_WORDS = 1_000_000     # words hashed in one go
SEEN = 200_000              # rows that a task remembers


def levels(length: int, start: int) -> list[int]:
    """Window lengths from ``start``, doubled, that end with ``length``."""
    out = [length]
    while out[0] % 2 == 0 and out[0] // 2 >= start:
        out.insert(0, out[0] // 2)
    return out


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on (shorter by
    length - 1): halves are joined; an odd length adds one word."""
    if len(words) < length:
        return words[:0]
    if length == 1:
        return words
    half = window_hashes(words, length // 2)
    n = len(words) - length // 2 * 2 + 1
    out = mix64(half[:n], half[length // 2:length // 2 + n])
    return mix64(out[:n - 1], words[length - 1:]) if length % 2 else out


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes, the position of the smallest (the
    first of equals)."""
    n = len(hashes) - width + 1
    best, at = hashes[:n].copy(), np.arange(n)
    for k in range(1, width):
        less = hashes[k:k + n] < best
        best[less] = hashes[k:k + n][less]
        at[less] = np.flatnonzero(less) + k
    return at


class _Chunk:
    """Words of many documents as one array; a window that would cross from
    one document into the next is masked out."""

    def __init__(self, texts: list, length: int):
        docs = [word_hashes(t) for t in texts]
        self.counts = np.array([len(d) for d in docs], np.int64)
        self.words = np.concatenate(docs) if docs else np.zeros(0, np.uint64)
        self.first = np.cumsum(self.counts) - self.counts
        n = max(0, len(self.words) - length + 1)
        self.doc = np.repeat(np.arange(len(docs)), self.counts)
        at = np.arange(n)
        self.valid = at + length <= (self.first + self.counts)[self.doc[:n]] if n else np.zeros(0, bool)

    def alive(self, marks: list, level: int, length: int) -> np.ndarray:
        """Windows whose minimizer of ``level`` words is marked as repeated."""
        at = minimizers(window_hashes(self.words, level), length - level + 1)
        marked = np.zeros(len(self.words), bool)
        for i, m in enumerate(marks):
            if m is not None:
                marked[self.first[i] + np.frombuffer(m, np.int32)] = True
        return self.valid & marked[at]


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches without rows whose (doc_id, text_hash) the task has seen;
    what it remembers is bounded, later repeats are only work."""
    seen: set = set()
    for b in batches:
        keep = []
        for key in zip(b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist()):
            keep.append(key not in seen)
            seen.add(key)
        if len(seen) > SEEN:
            seen.clear()
        yield b if all(keep) else b.filter(pa.array(keep, pa.bool_()))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Row groups of about CHUNK_WORDS words (a long document is whole)."""
    held, size = [], 0
    for b in _once(batches):
        lengths = pc.fill_null(pc.binary_length(b.column("text")), 0)
        begin = 0
        for i, n in enumerate(lengths.to_pylist()):
            size += n // 4 + 1
            if size >= CHUNK_WORDS:
                yield pa.Table.from_batches([*held, b.slice(begin, i + 1 - begin)])
                held, size, begin = [], 0, i + 1
        if begin < b.num_rows:
            held.append(b.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents that can have windows, under (doc_id, text_hash)."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").filter(
        "doc_id IS NOT NULL AND text IS NOT NULL")


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values).astype(np.int64, copy=False))


def _candidates(docs: DataFrame, marks: DataFrame | None) -> DataFrame:
    """Documents with the positions that the level before has marked."""
    if marks is None:
        return docs.withColumn("marks", F.lit(None).cast("binary"))
    return docs.join(marks, ["doc_id", "text_hash"])


def _settled_first(rows: DataFrame, *order: str) -> DataFrame:
    """Rows dealt by their key and sorted; what a chunk has settled travels by
    document, the rest by hash."""
    return rows.repartition("settled", "key").sortWithinPartitions("settled", "key", *order)


def _level(docs: DataFrame, marks: DataFrame | None, before: int | None, level: int, length: int) -> DataFrame:
    """(doc_id, text_hash, ats): positions of the repeated minimizers of
    ``level`` words, for the windows alive after ``before``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _chunks(batches):
            c = _Chunk(t.column("text").to_pylist(), length)
            if not c.valid.any():
                continue
            alive = c.valid if before is None else c.alive(t.column("marks").to_pylist(), before, length)
            hashes = window_hashes(c.words, level)
            at = np.unique(minimizers(hashes, length - level + 1)[alive])
            if not len(at):
                continue
            _, first, place, many = np.unique(hashes[at], return_index=True, return_inverse=True, return_counts=True)
            doc = c.doc[at]
            ids, texts = t.column("doc_id").to_numpy()[doc], t.column("text_hash").to_numpy()[doc]
            settled = many[place] > 1                    # repeated within this chunk
            witness = first[many > 1]                    # tells the other chunks
            key = np.concatenate([np.where(settled, ids, hashes[at].view(np.int64)), hashes[at[witness]].view(np.int64)])
            rows = np.concatenate([np.arange(len(at)), witness])
            yield pa.RecordBatch.from_arrays(
                [_long(key), pa.array(np.concatenate([settled, np.zeros(len(witness), bool)])),
                 _long(ids[rows]), _long(texts[rows]),
                 pa.array(np.concatenate([at - c.first[doc], np.full(len(witness), -1)]).astype(np.int32))],
                names=["key", "settled", "doc_id", "text_hash", "at"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, None             # the last row, if alone so far; the last key, if not
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks().to_batches()[0]
            key, settled = t.column("key").to_numpy(), t.column("settled").to_numpy(zero_copy_only=False)
            same = (key[1:] == key[:-1]) & (settled[1:] == settled[:-1])
            twin = np.r_[False, same] | np.r_[same, False]
            twin |= ~settled & (key == known) if known is not None else False
            keep = (settled | twin) & (t.column("at").to_numpy() >= 0)
            alone = not settled[-1] and not twin[-1]
            held = t.slice(t.num_rows - 1) if alone else None
            known = None if alone or settled[-1] else key[-1]
            yield t.select(["doc_id", "text_hash", "at"]).filter(pa.array(keep))

    rows = _candidates(docs, marks).mapInArrow(
        run, "key long, settled boolean, doc_id long, text_hash long, at int")
    return (_settled_first(rows).mapInArrow(repeated, "doc_id long, text_hash long, at int")
            .groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("ats")))


def _pack(marks: DataFrame) -> DataFrame:
    """The list of positions as the bytes of an int32 array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ats = b.column("ats")
            flat, off = ats.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ats.value_lengths().to_numpy())])
            packed = [flat[s:e].astype(np.int32).tobytes() for s, e in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(packed, pa.binary())],
                                             names=["doc_id", "text_hash", "marks"])

    return marks.mapInArrow(run, "doc_id long, text_hash long, marks binary")


def _later(docs: DataFrame, marks: DataFrame | None, before: int | None, length: int) -> DataFrame:
    """(doc_id, text_hash, at): the windows that also start earlier."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _chunks(batches):
            c = _Chunk(t.column("text").to_pylist(), length)
            if not c.valid.any():
                continue
            alive = c.valid if before is None else c.alive(t.column("marks").to_pylist(), before, length)
            at = np.flatnonzero(alive)
            hashes = window_hashes(c.words, length)[at]
            ids = t.column("doc_id").to_numpy()[c.doc[at]]
            texts = t.column("text_hash").to_numpy()[c.doc[at]]
            start = at - c.first[c.doc[at]]
            order = np.lexsort((start, ids, hashes))
            h, i, s = hashes[order], ids[order], start[order]
            new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
            lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            later = (i != i[lead]) | (s != s[lead])           # than the first of this chunk
            # settled rows travel by document, the others by their hash
            key = np.where(later, i, h.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [_long(key), pa.array(later), _long(i), pa.array(s.astype(np.int32)), _long(texts[order])],
                names=["key", "settled", "doc_id", "at", "text_hash"])

    def losers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None                         # hash, doc_id, start of the current first
        for b in batches:
            if not b.num_rows:
                continue
            h, i, s = (b.column(c).to_numpy() for c in ("key", "doc_id", "at"))
            settled = b.column("settled").to_numpy(zero_copy_only=False)
            new = np.r_[last is None or h[0] != last[0] or settled[0] != last[3],
                        (h[1:] != h[:-1]) | (settled[1:] != settled[:-1])]
            lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
            li, ls = i[np.maximum(lead, 0)], s[np.maximum(lead, 0)]
            if last is not None:
                li, ls = np.where(lead < 0, last[1], li), np.where(lead < 0, last[2], ls)
            yield b.select(["doc_id", "text_hash", "at"]).filter(pa.array(settled | (i != li) | (s != ls)))
            last = (h[-1], li[-1], ls[-1], settled[-1])

    rows = _candidates(docs, marks).mapInArrow(
        windows, "key long, settled boolean, doc_id long, at int, text_hash long")
    return (_settled_first(rows, "doc_id", "at").mapInArrow(losers, "doc_id long, text_hash long, at int"))


def repeated_windows(docs: DataFrame, length: int = LENGTH, start: int = START) -> DataFrame | None:
    """(doc_id, text_hash, marks): starts of the windows of ``length`` words
    whose sequence also starts earlier; None if no candidate survives."""
    texts, marks, before = _keyed(docs), None, None
    for level in levels(length, start)[:-1]:
        marks = staged(_pack(_level(texts, marks, before, level, length)), f"windows_{level}")
        before = level
        if marks.isEmpty():
            return None
    found = _later(texts, marks, before, length).groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("ats"))
    return staged(_pack(found), f"windows_{length}")


def remove_repeats(docs: DataFrame, length: int = LENGTH, start: int = START) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for each document."""
    marks = repeated_windows(docs, length, start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, kept = [], [], []
            for text, m in zip(b.column("text").to_pylist(), b.column("marks").to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                if m is not None:
                    cover = np.zeros(len(words) + 1, np.int32)
                    at = np.unique(np.frombuffer(m, np.int32))
                    cover[at] += 1
                    np.subtract.at(cover, at + length, 1)
                    gone = np.cumsum(cover[:-1]) > 0
                    left = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    left = words
                total.append(len(words)), removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    rows = rows.withColumn("marks", F.lit(None).cast("binary")) if marks is None else \
        rows.join(marks, ["doc_id", "text_hash"], "left")
    return rows.select("doc_id", "text", "marks").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_text string")


def op4_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated windows of 20 words removed from all ``documents``."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], length: int) -> dict:
    """doc_id -> (n_words, n_removed, sha256), word by word (for tests)."""
    first: dict = {}
    words = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(words):
        for s in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][s:s + length]), (i, s))
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s:s + length])] != (i, s):
                gone.update(range(s, s + length))
        left = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(left)).hexdigest())
    return out
