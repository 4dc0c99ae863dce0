"""Quality rules as a short-circuit cascade.

A document is kept if it fails no rule.  A rule that has failed settles the
verdict, so the order of the rules decides the cost, not the result: each
rule's CPU time and the share that it rejects are estimated on a sample, and
rules run by rejections per second, the highest first.  What several rules
need of a document (words, lines, repeated windows) is worked out once.

The sample is a Bernoulli sample of about ``sample_rows`` rows (2,000); every
row of the table is judged.  Estimates are summed by Spark, one row a rule.

Rules (a document fails if ...):
- ``few_words``: under 50 words;
- ``repeated_words``: more than half of its words lie in 3-word windows that
  the text holds twice or more;
- ``symbols``: characters of ``#*$%&|<>`` are more than a tenth of its words;
- ``repeated_lines``: more than half of its lines equal an earlier one (lines
  without words don't count);
- ``word_length``: its words have under 2 or over 15 characters on average;
- ``shouting``: more upper-case than lower-case ASCII letters;
- ``exclamations``: more ``!`` than a third of its words.

Cases: a null or empty text has no words: it fails.  A very long text is a
portion of its own in one task.  A null doc_id is returned, repeated rows give
a row each, an empty table gives none.  Only ``doc_id`` and ``text`` are read,
so other columns may have any name.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm.common import table

SAMPLE_ROWS = 2_000
SYMBOLS = b"#*$%&|<>"
_CONTINUED = bytes(range(0x80, 0xC0))                         # bytes of UTF-8 that begin no character
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def _count(raw: bytes, of: bytes) -> int:
    return len(raw) - len(raw.translate(None, of))


class Doc:
    """A text and what rules measure of it, each worked out when first asked for."""

    def __init__(self, text: str | None):
        self.raw = (text or "").encode("utf-8")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.raw.translate(None, b" \t\n\v\f\r" + _CONTINUED))

    @cached_property
    def n_symbols(self) -> int:
        return _count(self.raw, SYMBOLS)

    @cached_property
    def n_exclamations(self) -> int:
        return self.raw.count(b"!")

    @cached_property
    def n_upper(self) -> int:
        return _count(self.raw, _UPPER)

    @cached_property
    def n_lower(self) -> int:
        return _count(self.raw, _LOWER)

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines that have a word."""
        return [x for x in self.raw.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in 3-word windows that are found twice or more."""
        n = len(self.words)
        if n < 4:
            return 0
        number = {w: k for k, w in enumerate(set(self.words))}
        ids = np.fromiter(map(number.__getitem__, self.words), np.int64, n)
        pairs = ids[:-1] * len(number) + ids[1:]
        if len(number) ** 3 >= 1 << 62:                       # three numbers don't fit into one
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows = pairs[:-1] * len(number) + ids[2:]
        order = np.sort(windows)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice) == 0:
            return 0
        again = np.isin(windows, twice)
        held = np.zeros(n, bool)
        for k in range(3):
            held[k:n - 2 + k] |= again
        return int(held.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Doc], bool]


RULES = (
    Rule("few_words", lambda d: d.n_words < 50),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("repeated_lines", lambda d: 2 * d.n_dup_lines > d.n_lines),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 15 * d.n_words),
    Rule("shouting", lambda d: d.n_upper > d.n_lower),
    Rule("exclamations", lambda d: 3 * d.n_exclamations > d.n_words),
)


def estimates(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> DataFrame:
    """(rule, n, rejected, cpu_ns) on a Bernoulli sample of about ``sample_rows``
    rows; a rule's time includes all that it measures."""
    rows = docs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rejected, spent = 0, [0] * len(rules), [0] * len(rules)
        for b in batches:
            for text in b.column("text").to_pylist():
                n += 1
                for k, rule in enumerate(rules):
                    begun = time.thread_time_ns()
                    rejected[k] += rule.fails(Doc(text))
                    spent[k] += time.thread_time_ns() - begun
        yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "n": [n] * len(rules),
                                          "rejected": rejected, "cpu_ns": spent})

    sample = docs.select("text").sample(withReplacement=False, fraction=min(1.0, sample_rows / max(rows, 1)), seed=seed)
    return (sample.mapInArrow(run, "rule string, n long, rejected long, cpu_ns long").groupBy("rule")
            .agg(*(F.sum(c).alias(c) for c in ("n", "rejected", "cpu_ns"))))


def ordered(rules: Sequence[Rule], found: DataFrame) -> list[Rule]:
    """The rules by rejections per CPU second, the highest first (of equals,
    the cheapest)."""
    seen = {r.rule: r for r in found.collect()}               # one row a rule

    def rank(rule: Rule):
        r = seen.get(rule.name)
        return (-r.rejected / max(r.cpu_ns, 1), r.cpu_ns / max(r.n, 1)) if r else (0.0, 0.0)
    return sorted(rules, key=rank)


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, measures: Sequence[str] = ()) -> DataFrame:
    """doc_id, kept, failed_rule (the rule that settled it, null if kept),
    rules_run for each document, rules in the order given (see ``ordered``).
    ``measures`` are attributes of ``Doc`` (whole numbers) to return besides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            failed, tried, more = [], [], {m: [] for m in measures}
            for text in b.column("text"):                     # one document's words at a time
                doc, by, k = Doc(text.as_py()), None, 0
                for k, rule in enumerate(rules, 1):
                    if rule.fails(doc):
                        by = rule.name
                        break
                failed.append(by)
                tried.append(k)
                for m, values in more.items():
                    values.append(getattr(doc, m))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([f is None for f in failed], pa.bool_()), pa.array(failed, pa.string()),
                 pa.array(tried, pa.int32()), *(pa.array(v, pa.int64()) for v in more.values())],
                names=["doc_id", "kept", "failed_rule", "rules_run", *measures])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, ", ".join(["doc_id long, kept boolean, failed_rule string, rules_run int", *(f"{m} long" for m in measures)]))


def quality(docs: DataFrame, rules: Sequence[Rule] = RULES, measures: Sequence[str] = ()) -> DataFrame:
    """``cascade`` with the rules in the order that a sample of ``docs`` gives."""
    return cascade(docs, ordered(rules, estimates(docs, rules)), measures)


def op13_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` judged by the cascade, with the base measures.  The
    rule that settled a verdict hangs on measured times, so it isn't returned."""
    rows = quality(table(spark, sf_dir, "documents"),
                   measures=("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words").alias("base_failed"), "kept")


def oracle_sql() -> str:
    return r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (
  SELECT rid, unnest(list_transform(range(1, len(words) - 1),
         lambda i: {'i': i, 'g': words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]})) AS x FROM w),
again AS (
  SELECT rid, x.i AS i FROM win QUALIFY count(*) OVER (PARTITION BY rid, x.g) > 1),
held AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
m AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(held.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower, length(regexp_replace(t, '[^!]', '', 'g')) AS n_excl
  FROM w LEFT JOIN held USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR n_upper > n_lower OR 3 * n_excl > n_words) AS kept
FROM m
"""
