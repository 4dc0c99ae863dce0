"""Cross-tokenizer alignment by whitespace-token anchors.

Each text is encoded whole by two tokenizers: A, a byte-level BPE, reads a
space and the text; B, a SentencePiece model, reads the text and adds the space
itself.  Both token sequences are byte strings that must spell space + text.
Where a token of A and a token of B end together, the text is cut into
*groups*; the two tokens that end there are *linked*.

1. *Anchors.*  A byte offset at which a token of A and a token of B both begin,
   each with a space, is an anchor: what ends before it ends in both sequences
   (the offsets are compared, so this is verified, not assumed).  Anchors split
   the sequences into windows of token ids, about one a word.
2. *Memo.*  The alignment inside a window depends on its ids alone, so it is
   worked out once per tuple of A's and B's ids (packed) and looked up after that.
3. *Links.*  Two tokens can end together only if one's bytes end the other's.
   The vocabularies therefore bound the pairs that can ever be linked, by the
   sum of their tokens' lengths (times the ids that share bytes); these pairs
   are numbered beforehand, and a text's links are numbers.
4. *Counts.*  Each task counts links by number, the counts are added up by
   Spark, and the finished table, whose size the vocabularies bound and the
   corpus does not, goes to the tasks as a broadcast.

The merges of A are taken from its file and run by tiktoken, which gives the
ids of the tokenizers library at a quarter of its time; files it can't run and
texts with a run of white space too long for its stack are left to that
library.  Special tokens' strings inside a text are plain text.

Cases: a null or empty text, or one whose tokens don't spell space + text
(SentencePiece may normalise it), has no tokens and no groups.  A very long
text is one portion of its own, held whole by one task.  A null doc_id is
returned, repeated rows give a row each, an empty table gives none.  Only
``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm.common import portions, spelled, staged, table

CACHE = 100_000          # windows in each of the two generations of a worker's memo
LONG_SPACE = 10_000      # characters of white space in a row that tiktoken isn't given
# The word pattern of byte-level BPE vocabularies (a fixed value).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BETWEEN = b"\xff\xff\xff\xff"         # no id: stands between A's and B's in a packed tuple of ids

_ROW = "doc_id long, n_a long, n_b long, n_groups long, groups string, links binary"


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable
    bytes stand for themselves, the others for U+0100 and up, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """Tokenizer A: the ids of texts, special strings as plain text, and the
    bytes of each id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark runs one task a core
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        special = {t["id"] for t in made["added_tokens"]}
        ids, letters = made["model"]["vocab"], byte_alphabet()
        known = {i: bytes(map(letters.__getitem__, t)) for t, i in ids.items() if i not in special}
        self.bytes = [known.get(i, b"") for i in range(max(ids.values()) + 1)]
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in made["model"]["merges"]]
        self.long_space = re.compile(rf"\s{{{LONG_SPACE}}}")
        self.ranked = None
        # a merge's place is its result's id: the ids are the ranks
        if (made["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                                      "use_regex": True}
                and made["normalizer"] is None and not made["model"].get("ignore_merges")
                and all(ids.get(m) == 256 + k for k, m in enumerate(merges)) and len(known) == 256 + len(merges)):
            self.ranked = tiktoken.Encoding("a", pat_str=WORDS, special_tokens={},
                                            mergeable_ranks={b: i for i, b in known.items()})

    def encode(self, texts: list[str]) -> list[list[int]]:
        rest = [k for k, t in enumerate(texts) if self.ranked is None or self.long_space.search(t)]
        out: list = [None] * len(texts)
        for k, e in zip(rest, self.library.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return [self.ranked.encode_ordinary(t) if found is None else found for t, found in zip(texts, out)]


class PieceBpe:
    """Tokenizer B: the ids of texts and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes.append(b"\xff")                    # in no text
            else:
                self.bytes.append(piece.replace("▁", " ").encode("utf-8"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def linkable(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Every pair of ids that can end together, in ascending order: one's
    bytes end the other's.  At most the sum of all lengths, times the ids that
    have the same bytes."""
    by_a, by_b = {}, {}
    for of, by in ((a, by_a), (b, by_b)):
        for i, x in enumerate(of):
            if x:
                by.setdefault(x, []).append(i)
    pairs = {(i, j) for j, x in enumerate(b) for k in range(len(x)) for i in by_a.get(x[k:], ())}
    pairs.update((i, j) for i, x in enumerate(a) for k in range(len(x)) for j in by_b.get(x[k:], ()))
    return sorted(pairs)


class Aligner:
    """Both tokenizers, the numbers of the pairs and the memo of windows."""

    _own: dict = {}

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteBpe(a_path), PieceBpe(b_path)
        self.a_words, self.b_words = (pa.array(t.bytes, pa.large_binary()) for t in (self.a, self.b))
        self.a_size, self.b_size = (np.array([len(x) for x in t.bytes]) for t in (self.a, self.b))
        self.a_mark, self.b_mark = (np.array([x[:1] == b" " for x in t.bytes]) for t in (self.a, self.b))
        self.width = len(self.b.bytes)
        self.pairs = np.array([i * self.width + j for i, j in linkable(self.a.bytes, self.b.bytes)], np.int64)
        # an id followed by what can follow it: in a group, at its end, at a window's end
        self.written = [f"{i}{x}" for i in range(len(self.a.bytes)) for x in ",|"]
        self.written += [f"{i}{x}" for i in range(self.width) for x in ",;\n"]
        self.new: dict = {}
        self.old: dict = {}

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Aligner:
        """The aligner of this worker process."""
        if (a_path, b_path) not in cls._own:
            cls._own[a_path, b_path] = cls(a_path, b_path)
        return cls._own[a_path, b_path]

    def windows(self, keys: list[bytes]) -> list[tuple[str, bytes]]:
        """The groups of each window, as text, and its links' numbers (int32).
        The windows stand in a row: A's and B's bytes stay in step."""
        ids, size = np.frombuffer(b"".join(keys), "<i4"), np.array([len(k) // 4 for k in keys])
        middle = np.flatnonzero(ids == -1)
        place, turn = np.arange(len(ids)), np.repeat(middle, size)
        a, b = ids[place < turn].astype(np.int64), ids[place > turn].astype(np.int64)
        _, last_a, last_b = np.intersect1d(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]),
                                           assume_unique=True, return_indices=True)
        links = np.searchsorted(self.pairs, a[last_a] * self.width + b[last_b]).astype("<i4").tobytes()
        last_of_window = np.cumsum(np.cumsum(size) - 1 - middle) - 1              # in B
        groups = 4 * (np.searchsorted(last_b, last_of_window) + 1)
        # a group's tokens of A, then those of B
        place_a, place_b = np.arange(len(a)), np.arange(len(b))
        place_a += np.concatenate([[0], last_b[:-1] + 1])[np.searchsorted(last_a, place_a)]
        place_b += (last_a + 1)[np.searchsorted(last_b, place_b)]
        a, b = 2 * a, 2 * len(self.a.bytes) + 3 * b
        a[last_a] += 1
        b[last_b] += 1
        b[last_of_window] += 1
        order = np.empty(len(a) + len(b), np.int64)
        order[place_a], order[place_b] = a, b
        texts = "".join(map(self.written.__getitem__, order.tolist())).split("\n")
        return [(t, links[i:j]) for t, i, j in zip(texts, [0, *groups[:-1].tolist()], groups.tolist())]

    def learn(self, keys: set[bytes]) -> None:
        """Put the windows into the newer generation of the memo."""
        known = [(key, self.old[key]) for key in keys if key in self.old]
        unseen = list(keys.difference(self.old))
        self.new.update(known)
        if unseen:
            self.new.update(zip(unseen, self.windows(unseen)))

    def anchors(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
        """Where windows end in the packed ids of A and of B (the last included)."""
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        at_a, at_b = np.flatnonzero(self.a_mark[a[1:]]) + 1, np.flatnonzero(self.b_mark[b[1:]]) + 1
        shared, in_a, in_b = np.intersect1d(end_a[at_a - 1], end_b[at_b - 1], assume_unique=True, return_indices=True)
        return [*(4 * at_a[in_a]).tolist(), 4 * len(a)], [*(4 * at_b[in_b]).tolist(), 4 * len(b)]

    @staticmethod
    def _said(words: pa.Array, found: list[list[int]]) -> tuple[list[np.ndarray], list[bytes]]:
        """The ids of each text as an array, and the bytes they spell."""
        sizes = [len(x) for x in found]
        flat = np.fromiter(itertools.chain.from_iterable(found), "<i4", sum(sizes))
        return np.split(flat, np.cumsum(sizes)[:-1]), spelled(words, flat, sizes)

    def align(self, texts: list[str | None]) -> list[tuple[int, int, str, bytes]]:
        """(tokens of A, tokens of B, groups, links) of each text."""
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        live = [k for k, t in enumerate(texts) if t]
        out: list = [(0, 0, "", b"")] * len(texts)
        found_a = self.a.encode([" " + texts[k] for k in live])
        found_b = self.b.encode([texts[k] for k in live])
        (ids_a, said_a), (ids_b, said_b) = self._said(self.a_words, found_a), self._said(self.b_words, found_b)
        cut, unseen = [], set()
        for k, packed_a, packed_b, spelled_a, spelled_b in zip(live, ids_a, ids_b, said_a, said_b):
            if not spelled_a == (" " + texts[k]).encode("utf-8") == spelled_b:
                continue
            n_a, n_b = len(packed_a), len(packed_b)
            to_a, to_b = self.anchors(packed_a, packed_b)
            packed_a, packed_b = packed_a.tobytes(), packed_b.tobytes()
            keys = [packed_a[i:m] + BETWEEN + packed_b[j:n]
                    for i, m, j, n in zip([0, *to_a], to_a, [0, *to_b], to_b)]
            known = list(map(self.new.get, keys))
            holes = {i: keys[i] for i, x in enumerate(known) if x is None}
            unseen.update(holes.values())
            cut.append((k, n_a, n_b, known, holes))
        self.learn(unseen)
        for k, n_a, n_b, known, holes in cut:
            for i, key in holes.items():
                known[i] = self.new[key]
            groups, links = zip(*known)
            out[k] = (n_a, n_b, ";".join(groups), b"".join(links))
        return out


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups, links of each document: ``groups`` as
    ``a1,a2|b1;a3|b2,b3``, ``links`` as little-endian int32 numbers into
    ``linkable``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(a_path, b_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for k, e in portions(texts):
                rows = aligner.align(texts[k:e])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(k, e - k), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2].count("|") for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.binary())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _ROW)


def link_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): how many of the rows' ``links`` have each number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column("links"):
                part = np.bincount(np.frombuffer(raw.as_buffer() or b"", "<i4"))
                if len(part) > len(total):
                    total = np.concatenate([total, np.zeros(len(part) - len(total), np.int64)])
                total[:len(part)] += part
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(total[pair], pa.int64())],
                                         names=["pair", "n"])

    return rows.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def scored(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The rows with n_links, n_best and count_sum in the place of ``links``.

    The counts (one number for each linkable pair) are collected and broadcast:
    the two vocabularies bound them."""
    pairs = linkable(ByteBpe(a_path).bytes, PieceBpe(b_path).bytes)
    count = np.zeros(len(pairs), np.int64)
    found = link_counts(rows).toArrow()
    count[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    of_b = np.array([j for _, j in pairs], np.int64)
    highest = np.zeros(int(of_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, of_b, count)
    table_ = rows.sparkSession.sparkContext.broadcast((count, count == highest[of_b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = table_.value
        for batch in batches:
            links = [np.frombuffer(raw.as_buffer() or b"", "<i4") for raw in batch.column("links")]
            columns = dict(zip(batch.schema.names, batch.columns))
            del columns["links"]
            columns["n_links"] = pa.array([len(x) for x in links], pa.int64())
            columns["n_best"] = pa.array([int(best[x].sum()) for x in links], pa.int64())
            columns["count_sum"] = pa.array([int(count[x].sum()) for x in links], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "links"]
    return rows.mapInArrow(run, ", ".join([*fields, "n_links long", "n_best long", "count_sum long"]))


def op11_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` aligned between a byte-level and a SentencePiece
    vocabulary, with corpus-wide counts of linked ids."""
    import public_tokenizers
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    digest = F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    rows = aligned(table(spark, sf_dir, "documents"), *paths).select("doc_id", "n_a", "n_b", "n_groups", "links", digest)
    return scored(staged(rows, "alignment"), *paths).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


# ---------------------------------------------------------------- brute force

@functools.cache
def _libraries(a_path: str, b_path: str):
    import sentencepiece
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(a_path)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=b_path)


def brute_force(rows: list[tuple[int, str | None]], a_path: str, b_path: str) -> list[tuple]:
    """The rows of ``op11_anchors`` by the libraries alone, offset by offset."""
    import hashlib
    from collections import Counter
    first, second = _libraries(a_path, b_path)
    letters, made, count = byte_alphabet(), [], Counter()
    for doc_id, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
                   else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            made.append((doc_id, 0, 0, [], []))
            continue
        ends_a, ends_b = np.cumsum(list(map(len, a_bytes))).tolist(), np.cumsum(list(map(len, b_bytes))).tolist()
        shared = sorted(set(ends_a) & set(ends_b))
        in_a, in_b = (np.searchsorted(ends, shared, "right").tolist() for ends in (ends_a, ends_b))
        groups = [f"{','.join(map(str, a[i:k]))}|{','.join(map(str, b[j:m]))}"
                  for i, k, j, m in zip([0, *in_a], in_a, [0, *in_b], in_b)]
        links = [(x, y) for x, e in zip(a, ends_a) for y, f in zip(b, ends_b) if e == f] if len(a) < 400 else \
            [(a[k - 1], b[m - 1]) for k, m in zip(in_a, in_b)]
        count.update(links)
        made.append((doc_id, len(a), len(b), groups, links))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(doc_id, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[1]] for p in links),
             sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for doc_id, n_a, n_b, groups, links in made]
