"""Secret scans: patterns, and a character convolutional network over every
candidate and its surroundings.

*Base spans* come from the three patterns below and always stay.  *Candidates*
are the base spans, all runs of 16 or more token characters that touch none of
them, and what base spans leave of such a run (8 characters or more); the
latter two need a digit or an upper-case letter after a lower-case one.  The
network reads each candidate with 24 characters before and 8 after it (byte
classes, embedding, one convolution, maximum over positions, a dense layer).
Its calibrated probability is the score of every span; candidates beside the
base spans that reach the threshold are added as kind ``model``.  It is written
in numpy, trained once per process on labelled findings that
``labelled_findings`` makes from a fixed seed: credentials of many formats, and
look-alikes (addresses, paths, numbers, versions, dates, long words) in plain
text.  Scores are calibrated on a second part of the findings (Platt scaling);
the threshold is the highest at which ``spans`` covers ``MIN_RECALL`` of those
secrets of a third part that the patterns alone don't cover.

A candidate longer than the window is read in windows that overlap by half;
the best one counts.  A text of any length takes time in proportion to it:
spans and runs are merged in order, and windows are read some thousands at a
time.

Nulls and ties: a null text counts as empty and has no spans; a null doc_id
is returned; repeated rows give a row each; an empty table gives none.  Only
``doc_id`` and ``text`` are read by ``scan``; ``redact`` hands on every other
column, also one named like a span kind or a score.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm.common import portions, table

KINDS = ("assign", "access", "hex", "model")
# The base patterns and the shortest match (group 2 for assignments).
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST_VALUE = 6
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=~-]{16,}")
DIGIT = re.compile(r"[0-9]")
MIXED = re.compile(r"[0-9]|[a-z][A-Z]")
SHORTEST_REST = 8        # characters that base spans leave of a run

BEFORE, INSIDE, AFTER = 24, 48, 8
WINDOW = BEFORE + INSIDE + AFTER
EMBED, FILTERS, WIDTH, HIDDEN = 8, 32, 5, 16
MIN_RECALL = 0.98
FINDINGS = 3_000
EPOCHS = 12
READ = 4_096             # windows read at a time


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, in order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= SHORTEST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if DIGIT.search(text) or HEX.search(text):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of token characters with a digit or mixed case, without the parts
    that the base spans (in order) cover."""
    out, k = [], 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        done, touched = start, False
        while k < len(base) and base[k][0] < end:
            s, _, e = base[k]
            if e > start:
                touched = True
                if s - done >= SHORTEST_REST and MIXED.search(text, done, s):
                    out.append((done, s))
                done = max(done, e)
                if e > end:
                    break                    # it may reach into the next run
            k += 1
        if end - done >= (SHORTEST_REST if touched else 1) and MIXED.search(text, done, end):
            out.append((done, end))
    return out


# ---------------------------------------------------------------- windows

_CLASS = np.array([96] * 33 + list(range(2, 96)) + [97], np.uint8)


def _classes(text: str) -> np.ndarray:
    """Character classes between padding: printable ASCII 2..95, white space
    and control 96, others 97, padding 0."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(BEFORE + len(points) + INSIDE + AFTER, np.uint8)
    out[BEFORE:BEFORE + len(points)] = _CLASS[np.minimum(points, 127)]
    return out


def _cut(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, end) of the windows of spans."""
    step = INSIDE // 2
    many = np.maximum(1, -(-(end - step - start) // step))
    owner = np.repeat(np.arange(len(start)), many)
    s = start[owner] + step * (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many))
    return owner, s, np.minimum(end[owner], s + INSIDE)


def _codes(classes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One row of classes per window (places in ``classes``); 98 more marks the
    span itself."""
    left = classes[start[:, None] + np.arange(-BEFORE, 0)]
    at = start[:, None] + np.arange(INSIDE)
    inside = np.where(at < end[:, None], classes[at] + np.uint8(98), np.uint8(0))
    return np.concatenate([left, inside, classes[end[:, None] + np.arange(AFTER)]], axis=1)


# ---------------------------------------------------------------- findings

_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_SYLLABLES = ("the an re on er in ti es at nd or ou ha en th ing le de la un par ein der sch ich "
              "os ado que mente con por").split()


def labelled_findings(n: int, seed: int) -> list[tuple[str, int, int, int]]:
    """(text, start, end, is a secret), half of them secrets."""
    rng = np.random.default_rng(seed)

    def pick(xs):
        return xs[rng.integers(len(xs))]

    def chars(alphabet, k):
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), k))

    def word():
        return "".join(pick(_SYLLABLES) for _ in range(rng.integers(1, 5)))

    def prose(k):
        return " ".join(word() for _ in range(k))

    def secret():
        k = int(rng.integers(20, 64))
        kind = rng.integers(9)
        if kind == 0:
            return "AKIA" + chars("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)
        if kind == 1:
            return pick(["ghp_", "gho_", "glpat-", "xoxb-", "sk_live_", "sk-", "pk_test_", "npm_"]) + chars(_ALNUM, k)
        if kind == 2:
            return ".".join(["eyJ" + chars(_ALNUM, 20), chars(_ALNUM + "-_", k), chars(_ALNUM + "-_", 30)])
        if kind == 3:
            return chars("0123456789abcdef", int(pick([32, 40, 64])))
        if kind == 4:
            return chars(_ALNUM + "+/", k) + pick(["", "=", "=="])
        if kind == 5:
            return "AIza" + chars(_ALNUM + "-_", 35)
        if kind == 6:
            return chars("0123456789ABCDEF", int(pick([32, 40])))
        if kind == 7:
            return "aB" + chars(_ALNUM[:52], k)              # no digit
        return chars(_ALNUM, k)

    def harmless():
        kind = rng.integers(13)
        if kind == 0:
            return chars("0123456789", int(rng.integers(16, 24)))
        if kind == 1:
            return "/".join([word() for _ in range(4)]) + "/" + chars("0123456789", int(rng.integers(1, 6)))
        if kind == 2:
            return f"www.{word()}{word()}.example.com/{word()}/{rng.integers(1, 99999)}"
        if kind == 3:
            return f"20{rng.integers(10, 30)}-0{rng.integers(1, 10)}-{rng.integers(10, 29)}T{rng.integers(10, 24)}"
        if kind == 4:
            return f"{word()}-{word()}-{word()}-v{rng.integers(1, 30)}.{rng.integers(0, 99)}.{rng.integers(0, 99)}"
        if kind == 5:
            return word() + word() + word() + word() + str(rng.integers(0, 9999))
        if kind == 6:
            return "_".join(word() for _ in range(4)) + str(rng.integers(0, 99))
        if kind == 7:
            return "+" + "-".join(chars("0123456789", 4) for _ in range(4))
        if kind == 8:
            return f"{word()}.{word()}{rng.integers(1, 999)}.{word()}.example.org"
        if kind == 9:
            return word() + "".join(word().capitalize() for _ in range(int(rng.integers(3, 6))))
        if kind == 10:
            return pick([".", "/", "-", "..."]).join([word() + word(), (word() + word()).capitalize(), word().capitalize()])
        return pick(["=", "-", "_"]) * int(rng.integers(14, 40)) + str(rng.integers(0, 9))

    names = ["token", "secret", "password", "api_key", "apikey", "key", "Authorization", "auth", "credential", "pwd"]
    out = []
    for k in range(n):
        is_secret = k % 2
        body = secret() if is_secret else harmless()
        lead = pick([" ", " ", "\n", ", ", ' "', " (", " | "])
        if is_secret and rng.random() < 0.6:
            lead = " " + pick(names) + pick([" = ", ": ", "=", ' = "', ": '", " Bearer ", " is "])
        elif not is_secret and rng.random() < 0.3:
            lead = " " + pick(["see", "page", "call", "on", "file", "ref", "id"]) + pick([" ", ": "])
        left, right = prose(int(rng.integers(0, 8))) + lead, pick([" ", ". ", '" ', "\n", ", "]) + prose(4)
        beside = rng.random()
        if is_secret and beside < 0.08:                      # what a pattern leaves of a longer secret
            left = prose(3) + " " + pick(names[:5]) + pick(["=", ": "]) + chars(_ALNUM, int(rng.integers(6, 13)))
            body = "~" + chars(_ALNUM, int(rng.integers(12, 33)))
        elif not is_secret and beside < 0.06:                # what stands before one
            body = "/".join([word(), word() + str(rng.integers(1, 999)), word() + "-"])
            right = pick(names[:5]) + "=" + chars(_ALNUM, 16) + right
        out.append((left + body + right, len(left), len(left) + len(body), is_secret))
    return out


# ---------------------------------------------------------------- network

class CharNet:
    """Embedding, convolution, maximum over positions, dense layer, logit."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {"e": rng.normal(0, 0.3, (196, EMBED)),
                  "k": rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)), "kb": np.zeros(FILTERS),
                  "h": rng.normal(0, FILTERS ** -0.5, (FILTERS, HIDDEN)), "hb": np.zeros(HIDDEN),
                  "o": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "ob": np.zeros(1)}
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x):
        p = self.p
        emb = p["e"][x]
        win = np.lib.stride_tricks.sliding_window_view(emb, WIDTH, axis=1).transpose(0, 1, 3, 2)
        win = win.reshape(len(x), -1, WIDTH * EMBED)
        conv = win @ p["k"] + p["kb"]
        at = conv.argmax(axis=1)
        top = np.take_along_axis(conv, at[:, None, :], 1)[:, 0]
        pooled = np.maximum(top, 0)
        pre = pooled @ p["h"] + p["hb"]
        hid = np.maximum(pre, 0)
        return hid @ p["o"] + p["ob"], (win, at, top, pooled, pre, hid)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + 256])[0] for i in range(0, len(x), 256)]) if len(x) else np.zeros(0)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        """Adam on the logistic loss; gradients by hand."""
        rng, p = np.random.default_rng(seed), self.p
        m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 64):
                rows = order[i:i + 64]
                xb, n = x[rows], len(rows)
                out, (win, at, top, pooled, pre, hid) = self._forward(xb)
                d = (1 / (1 + np.exp(-out)) - y[rows]) / n
                g = {"o": hid.T @ d, "ob": d.sum(keepdims=True)}
                dh = np.outer(d, p["o"]) * (pre > 0)
                g["h"], g["hb"] = pooled.T @ dh, dh.sum(0)
                dt = (dh @ p["h"].T) * (top > 0)
                g["kb"] = dt.sum(0)
                picked = win[np.arange(n)[:, None], at]              # n, filters, width * embed
                g["k"] = np.einsum("nfw,nf->wf", picked, dt)
                de = (dt[:, :, None] * p["k"].T).reshape(n, FILTERS, WIDTH, EMBED)
                ids = xb[np.arange(n)[:, None, None], at[:, :, None] + np.arange(WIDTH)]
                g["e"] = np.zeros_like(p["e"])
                np.add.at(g["e"], ids.ravel(), de.reshape(-1, EMBED))
                t += 1
                for k in p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    p[k] -= 3e-3 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling by Newton steps."""
        z = self.logits(x)
        a, b = 1.0, 0.0
        for _ in range(30):
            q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            w = q * (1 - q) + 1e-6
            g = np.array([((q - y) * z).sum() + 1e-2 * (a - 1), (q - y).sum()])
            h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum()]])
            a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
        self.scale, self.shift = float(a), float(b)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x) + self.shift, -30, 30)))

    def constrain(self, findings, recall: float = MIN_RECALL) -> None:
        """The highest threshold at which ``spans`` covers ``recall`` of the
        secrets that the patterns alone don't."""
        own = covered_at([f for f in findings if f[3]], self)
        own = np.sort(own[own < np.inf])
        if len(own):
            lowest = float(own[int(np.floor((1 - recall) * len(own)))])
            if lowest < 0:
                raise ValueError("too many secrets are no candidates for this recall")
            self.threshold = lowest


def _windows(findings) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each finding, and its label."""
    rows = []
    for t, s, e, _ in findings:
        _, start, end = _cut(np.array([s]), np.array([e]))
        rows.append(_codes(_classes(t), start[:1] + BEFORE, end[:1] + BEFORE))
    return np.concatenate(rows), np.array([float(f[3]) for f in findings])


def covered_at(findings, net: CharNet) -> np.ndarray:
    """For each finding the highest threshold at which spans cover all of it:
    infinite if the patterns do, -1 if candidates leave a part of it."""
    out = []
    for (_, start, end, _), parts in zip(findings, _scored([f[0] for f in findings], net)):
        done, least = start, np.inf
        for s, kind, e, p in parts:                          # in order
            if s <= done < e:
                done, least = e, least if kind < 3 else min(least, p)
            if done >= end:
                break
        out.append(least if done >= end else -1.0)
    return np.array(out)


@functools.lru_cache(maxsize=2)
def trained(findings: int = FINDINGS, recall: float = MIN_RECALL) -> CharNet:
    net = CharNet()
    net.fit(*_windows(labelled_findings(findings, 1)))
    net.calibrate(*_windows(labelled_findings(findings // 3, 2)))
    net.constrain(labelled_findings(findings // 3, 3), recall)
    return net


def _scored(texts: list[str], net: CharNet) -> list[list[tuple[int, int, int, float]]]:
    """(start, kind, end, score) of all candidates of each text, in order; the
    network reads those of many texts together."""
    found, shift, classes, at = [], [], [], 0
    for t in texts:
        base = base_spans(t)
        found.append(sorted(base + [(s, 3, e) for s, e in candidates(t, base)]))
        shift.append(at + BEFORE)
        if found[-1]:
            classes.append(_classes(t))
            at += len(classes[-1])
    if not classes:
        return [[] for _ in texts]
    place = np.concatenate(classes)
    move = np.repeat(np.array(shift), [len(f) for f in found])
    owner, start, end = _cut(np.array([s for f in found for s, _, _ in f]) + move,
                             np.array([e for f in found for _, _, e in f]) + move)
    score = np.concatenate([net.probability(_codes(place, start[i:i + READ], end[i:i + READ]))
                            for i in range(0, len(start), READ)])
    best = np.maximum.reduceat(score, np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]))
    scores = iter(np.round(best, 6).tolist())
    return [[(s, k, e, next(scores)) for s, k, e in f] for f in found]


def _accepted(texts: list[str], net: CharNet) -> Iterator[list[tuple[int, int, int, float]]]:
    """The spans of each text with their scores: base spans, and candidates
    from the threshold on."""
    for begin, end in portions(texts):
        for parts in _scored(texts[begin:end], net):
            yield [x for x in parts if x[1] < 3 or x[3] >= net.threshold]


def spans(text: str, net: CharNet) -> list[tuple[int, int, int]]:
    """(start, kind, end) of base spans and accepted candidates, in order."""
    return [x[:3] for x in next(_accepted([text], net))]


def _joined(parts: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in parts)


def scan(docs: DataFrame, findings: int = FINDINGS, recall: float = MIN_RECALL) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, scores (of the
    spans, by the network) per document."""
    net = docs.sparkSession.sparkContext.broadcast(trained(findings, recall))     # 20 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scored = list(_accepted([t or "" for t in b.column("text").to_pylist()], net.value))
            every = [[x[:3] for x in f] for f in scored]
            base = [[x for x in f if x[1] < 3] for f in every]
            n = [pa.array([sum(x[1] == k for x in f) for f in base], pa.int64()) for k in range(3)]
            digest = [hashlib.sha256(_joined(f).encode()).hexdigest() for f in base]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), *n, pa.array(digest, pa.string()),
                 pa.array([_joined(f) for f in every], pa.string()),
                 pa.array([[x[3] for x in f] for f in scored], pa.list_(pa.float64()))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "scores"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
             "scores array<double>")


def redact(docs: DataFrame, findings: int = FINDINGS, recall: float = MIN_RECALL) -> DataFrame:
    """The documents with each run of spans replaced by ``[SECRET]``;
    ``n_chars`` follows the text where it changes."""
    net = docs.sparkSession.sparkContext.broadcast(trained(findings, recall))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        values = [None if t is None else str(t) for t in texts]
        out = []
        for t, parts in zip(values, _accepted([t or "" for t in values], net.value)):
            if t is not None and parts:
                pieces, done = [], 0
                for s, _, e, _ in parts:
                    if s >= done:
                        pieces += [t[done:s], "[SECRET]"]
                    done = max(done, e)
                t = "".join(pieces) + t[done:]
            out.append(t)
        return pd.Series(out, dtype=object)

    new = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), clean(docs["text"]).alias("clean"))
    return new.select(*[F.col("clean").alias(f.name) if f.name == "text"
                        else F.when(F.col("row.text") == F.col("clean"), F.col("row.n_chars"))
                        .otherwise(F.length("clean").cast(f.dataType)).alias(f.name) if f.name == "n_chars"
                        else F.col("row").getField(f.name).alias(f.name) for f in docs.schema])


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``."""
    return scan(table(spark, sf_dir, "documents"))
