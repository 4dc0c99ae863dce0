"""Periodic run detection in words, and their removal.

A *run* is a stretch of consecutive words with smallest period q that is at
least max(``least``, ``times`` * q) words long and that no neighbouring word
extends with period q.

1. *Harmonic grid.*  A run of period q holds at least (times - 1) * q words
   that equal the word q further on, so one of the positions 0, g, 2g, ... with
   g = max(1, times - 2) * q lies among them with q more of them behind it.
   Over all periods that is a harmonic sum of positions.  A grid position whose
   own word, middle word or last word of those q differs is no run's.
2. *Longest common extensions.*  From a grid position p, the stretch of period
   q reaches as far as the texts from p and from p + q agree, forwards, and
   those that end before them, backwards.  That is answered by a difference
   cover: modulo 31, every distance is the difference of two of six residues.
   Only suffixes that begin at those residues are sorted.  Two positions
   compare the few words to the next place where both are sampled, and if all
   agree, a range minimum (sparse table) over the sorted suffixes' common
   prefixes gives the rest.  Backwards, the same over the reversed words.
3. *Runs.*  Equal stretches found under several periods keep the smallest;
   periods of one stretch are multiples of it, as it is four times as long.

Many documents are worked on as one array; a separator of its own behind each
ends every extension.  The structure is built for documents in which a grid
position got through, alone.  Words are compared by exact numbers, not hashes.

Cases: a null or empty text has no words, no runs and the kept text "".  A
very long text is one array of its own in one task, of memory in proportion.
A null doc_id is returned; repeated rows give a row each; an empty table gives
none.  Only ``doc_id`` and ``text`` are read, so other columns may have any
name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm.common import portions, table

# Every number modulo 31 is a difference of two of these (a fixed value).
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
GRID = 4_000_000         # grid positions tried in one go


def _shifts() -> np.ndarray:
    """For residues (i, j), the least d with i + d and j + d both in the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[list(COVER)] = True
    out = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    at = np.arange(MODULUS)
    for d in range(MODULUS - 1, -1, -1):
        both = inside[(at + d) % MODULUS][:, None] & inside[(at + d) % MODULUS][None, :]
        out[both] = d
    return out


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions of positions of an array of words (numbers
    from 1), whose last word stands nowhere else."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        # words of its own behind the end, so that every window is whole
        self.words = np.concatenate([words, words.max(initial=0) + 1 + np.arange(2 * MODULUS)]).astype(np.int64)
        at = np.flatnonzero(np.isin(np.arange(n + MODULUS) % MODULUS, COVER))
        windows = np.lib.stride_tricks.sliding_window_view(self.words, MODULUS)[at].astype(">u4")
        key = np.ascontiguousarray(windows).view(f"V{4 * MODULUS}").ravel()
        _, rank = np.unique(key, return_inverse=True)
        levels = [rank]
        step = 1
        while len(np.unique(rank)) < len(at):
            nxt = at + MODULUS * step
            place = np.minimum(np.searchsorted(at, nxt), len(at) - 1)
            later = np.where(nxt <= at[-1], rank[place] + 1, 0)
            _, rank = np.unique(rank * np.int64(len(at) + 1) + later, return_inverse=True)
            levels.append(rank)
            step *= 2
        self.rank = np.full(n + MODULUS, -1, np.int64)
        self.rank[at] = rank
        order = np.empty(len(at), np.int64)
        order[rank] = at
        self.table = self._minima(self._neighbours(order, at, levels))

    def _neighbours(self, order: np.ndarray, at: np.ndarray, levels: list) -> np.ndarray:
        """Common prefix of each sorted suffix with the next one."""
        i, j = order[:-1].copy(), order[1:].copy()
        for k in range(len(levels) - 1, -1, -1):
            place_i, place_j = np.searchsorted(at, i), np.searchsorted(at, j)
            inside = (place_i < len(at)) & (place_j < len(at))
            same = np.zeros(len(i), bool)
            same[inside] = levels[k][place_i[inside]] == levels[k][place_j[inside]]
            i[same] += MODULUS << k
            j[same] += MODULUS << k
        done = i - order[:-1]
        return done + self._compare(i, j, np.full(len(i), MODULUS))

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most``, word by word."""
        out = np.zeros(len(i), np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            live = live[self.words[i[live] + out[live]] == self.words[j[live] + out[live]]]
            out[live] += 1
            live = live[out[live] < most[live]]
        return out

    @staticmethod
    def _minima(common: np.ndarray) -> list[np.ndarray]:
        """Sparse table: minima of 1, 2, 4, ... neighbours."""
        out = [common]
        while len(out[-1]) > 1 << (len(out) - 1):
            half = 1 << (len(out) - 1)
            out.append(np.minimum(out[-1][:-half], out[-1][half:]))
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j (i != j) on."""
        few = SHIFTS[i % MODULUS, j % MODULUS]
        out = self._compare(i, j, few)
        far = np.flatnonzero(out == few)
        if len(far):
            x, y = self.rank[i[far] + few[far]], self.rank[j[far] + few[far]]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(float))[1] - 1
            for k in np.unique(level).tolist():
                m = level == k
                t = self.table[k]
                out[far[m]] += np.minimum(t[low[m]], t[high[m] - (1 << k)])
        return out


def _grid(sizes: np.ndarray, first: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, period) of the harmonic grid, in portions; documents stand in
    descending order of size, so those long enough for a period come first."""
    longest = int(sizes[0]) if len(sizes) else 0
    ends = first + sizes
    held, size = [], 0
    for q in range(1, longest // times + 1):
        n = int(np.searchsorted(-sizes, -max(least, times * q), side="right"))
        if n == 0:
            break
        at = np.arange(0, ends[n - 1], max(1, times - 2) * q)
        held.append((at, q))
        size += len(at)
        if size >= GRID:
            yield np.concatenate([a for a, _ in held]), np.repeat([q for _, q in held], [len(a) for a, _ in held])
            held, size = [], 0
    if held:
        yield np.concatenate([a for a, _ in held]), np.repeat([q for _, q in held], [len(a) for a, _ in held])


def find_runs(docs: list[np.ndarray], least: int = 6, times: int = 4) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each document (an array of word
    numbers, any of which may be in several documents), by start and period."""
    if times < 2 or least < 2:
        raise ValueError("runs need a period that comes back")
    out: list = [[] for _ in docs]
    by_size = sorted((k for k, d in enumerate(docs) if len(d) >= max(least, times)), key=lambda k: -len(docs[k]))
    if not by_size:
        return out
    top = 1 + max(int(docs[k].max()) for k in by_size)
    words = np.concatenate([np.append(docs[k], top + i) for i, k in enumerate(by_size)])
    sizes = np.array([len(docs[k]) for k in by_size])
    first = np.cumsum(sizes + 1) - sizes - 1
    found = [(at, q) for at, q in _survivors(words, sizes, first, least, times)]
    at, q = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    if len(at) == 0:
        return out
    # the documents that hold one, as an array of their own
    doc = np.searchsorted(first, at, side="right") - 1
    live = np.unique(doc)
    own = np.concatenate([words[first[d]:first[d] + sizes[d] + 1] for d in live.tolist()])
    moved = np.cumsum(sizes[live] + 1) - sizes[live] - 1
    at += (moved - first[live])[np.searchsorted(live, doc)]
    end = at + q + Extensions(own)(at, at + q)
    start = at - Extensions(own[::-1])(len(own) - at, len(own) - at - q)
    keep = end - start >= np.maximum(least, times * q)
    start, end, q = start[keep], end[keep], q[keep]
    order = np.lexsort((q, end, start))                       # of one stretch the smallest period first
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    place = np.searchsorted(moved, start, side="right") - 1
    order = np.lexsort((q, start))
    for d, s, e, p in zip(live[place][order].tolist(), (start - moved[place])[order].tolist(),
                          (end - start)[order].tolist(), q[order].tolist()):
        out[by_size[d]].append((s, e, p))
    return out


def _survivors(words: np.ndarray, sizes: np.ndarray, first: np.ndarray, least: int,
               times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid positions whose next words, tried at three places, come back a
    period later."""
    for at, q in _grid(sizes, first, least, times):
        span = (times - 1 - max(1, times - 2)) * q + 1        # as many come back, from a run's first grid position on
        inside = at + span + q <= len(words)
        at, q, span = at[inside], q[inside], span[inside]
        for there in (lambda n: n - 1, lambda n: n // 2, lambda n: 0 * n):
            i = at + there(span)
            same = words[i] == words[i + q]
            at, q, span = at[same], q[same], span[same]
        if len(at):
            yield at, q


# ---------------------------------------------------------------- documents

Change = Callable[[int | None, list[bytes]], list[bytes]]


def collapse_runs(docs: DataFrame, least: int = 6, times: int = 4, change: Change | None = None) -> DataFrame:
    """doc_id, n_words, runs, kept_text for each document: its runs by start
    and period, and the words that no run holds after its first period, joined
    by one space.  ``change`` maps (doc_id, words) to the words to work on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for k, e in portions(texts):
                words = [(t or "").encode("utf-8").split() for t in texts[k:e]]
                if change is not None:
                    words = [change(i, w) for i, w in zip(ids[k:e], words)]
                number = {w: n for n, w in enumerate(set().union(*words), 1)}
                found = find_runs([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words], least, times)
                flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
                runs = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, found)]), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[k:e], pa.int64()), pa.array(list(map(len, words)), pa.int64()), runs,
                     pa.array([b" ".join(_kept(w, r)).decode("utf-8") for w, r in zip(words, found)], pa.string())],
                    names=["doc_id", "n_words", "runs", "kept_text"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept_text string")


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of ``op12_periodic``: of documents that a hash of their id
    picks (about a tenth), the words from a place on repeat their first ones."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or n == 0:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % period] for k in range(n - a)]


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all ``documents`` with four periods or more, and their texts
    without them."""
    def line(r):
        return F.concat_ws(",", r["start"], r["length"], r["period"])

    def greater(best, r):
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    rows = collapse_runs(table(spark, sf_dir, "documents"), change=repeated_tail)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.aggregate("runs", none, greater)                 # of equals the first by start and period
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"))


# ---------------------------------------------------------------- brute force

def brute_force(words: list, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """Runs of one document, period by period and word by word."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())
