import hashlib
import re
import time

import numpy as np

from flowline.llm import secrets as S
from tests.llm.conftest import by_id

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    """The contract's three kinds, written out."""
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def joined(spans):
    return ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_scan(docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = by_id(S.scan(docs))
    assert set(got) == set(texts)
    for k, r in got.items():
        want = base(texts[k])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == j for x in want) for j in range(3)]
        assert r["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest()
        assert set(filter(None, joined(want).split(","))) <= set(filter(None, r["spans"].split(",")))


def test_tricky_base_spans():
    for t in ('token: token: abcdef', 'Token="key=abcdefgh"', "API_KEY = '12345' api-key: zzzzzz", "AKIAAKIA" + "A" * 12,
              "Key apikey:abcdef", "secret :  \"ab.c/d+e=\"", "f" * 23 + " " + "f" * 24 + "g", "paſſword=abcdefgh"):
        assert S.base_spans(t) == base(t), t


def test_held_out_findings():
    net = S.trained()
    x, y = S._windows(S.labelled_findings(900, 99))
    hit = net.probability(x) >= net.threshold
    assert hit[y == 1].mean() >= 0.95 and y[hit].mean() >= 0.97


def test_calibration():
    net = S.trained()
    x, y = S._windows(S.labelled_findings(900, 98))
    p = net.probability(x)
    assert np.mean((p - y) ** 2) < 0.03


def test_new_kinds_are_added_and_prose_left_alone():
    net = S.trained()
    secret = "use ghp_9aB3xK2mQ7wE5rT1yU8iO4pL6zX0cV2bN4mA now"
    assert [k for _, k, _ in S.spans(secret, net)] == [3]
    assert S.spans("see page 4541241989961675 at www.example.com/page/12", net) == []
    assert S.spans("", net) == []


def test_redact(docs, no_docs):
    out = S.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    hit = out.filter("text LIKE '%[SECRET]%'").select("text", "n_chars").collect()
    assert len(hit) == 1 and "0123456789abcdef" not in hit[0].text and "AKIA" not in hit[0].text
    assert hit[0].n_chars == len(hit[0].text)
    assert S.redact(no_docs).count() == 0 and S.scan(no_docs).count() == 0


def plain_candidates(text):
    """Runs cut at every character that a base span covers, one by one."""
    taken = [False] * len(text)
    for s, _, e in base(text):
        taken[s:e] = [True] * (e - s)
    out = []
    for m in re.finditer("[A-Za-z0-9+/_.=~-]{16,}", text):
        touched = any(taken[m.start():m.end()])
        parts, begin = [], m.start()
        for i in range(m.start(), m.end() + 1):
            if i == m.end() or taken[i]:
                parts.append((begin, i))
                begin = i + 1
        for s, e in parts:
            if e - s >= (8 if touched else 16) and re.search("[0-9]|[a-z][A-Z]", text[s:e]):
                out.append((s, e))
    return out


def test_candidates_beside_base_spans():
    rng = np.random.default_rng(5)
    bits = ["password=abc123", "~9f8e7d6c5b4a", "AKIA" + "B7" * 9, "0123456789abcdef" * 2, " ", "\n", "xY", "lower/case-",
            "token: secret=abcdefgh", "Z~", "é", "aBcDeFgH", "=1234567"]
    for _ in range(2_000):
        text = "".join(bits[i] for i in rng.integers(0, len(bits), rng.integers(1, 9)))
        assert S.candidates(text, S.base_spans(text)) == plain_candidates(text), text


def test_recall_end_to_end():
    net = S.trained()
    made = S.labelled_findings(1_500, 97)
    at = S.covered_at([f for f in made if f[3]], net)
    assert (at >= net.threshold).mean() >= 0.98 and (at >= 0).all()
    harmless = [f for f in made if not f[3]]
    hits = [any(k == 3 and s < e and start < b for s, k, b in S.spans(t, net)) for t, start, e, _ in harmless]
    assert np.mean(hits) <= 0.01


def test_rests_and_keys_without_digits():
    net = S.trained()
    assert S.spans("password=abc123~9f8e7d6c5b4a3f2e1d", net) == [(0, 0, 15), (15, 3, 34)]
    assert S.spans("qWeRtYuIoPaSdFgHjKlZxCvBnM", net) == [(0, 3, 26)]


def test_windows_one_by_one():
    text = "päss " + "aB3" * 60 + " \x7f\t end"
    classes = S._classes(text)
    owner, start, end = S._cut(np.array([0, 5, 5]), np.array([4, 185, 21]))
    got = S._codes(classes, start + S.BEFORE, end + S.BEFORE)
    want = []
    for s, e in ((0, 4), (5, 185), (5, 21)):
        for a in range(s, max(s + 1, e - 24), 24):
            b = min(e, a + 48)
            kind = [96 if ord(c) <= 32 else ord(c) - 31 if ord(c) < 127 else 97 for c in text]
            left, inside, right = kind[max(0, a - 24):a], [c + 98 for c in kind[a:b]], kind[b:b + 8]
            want.append([0] * (24 - len(left)) + left + inside + [0] * (48 - len(inside)) + right + [0] * (8 - len(right)))
    assert got.tolist() == want and np.bincount(owner).tolist() == [1, 7, 1]


def test_many_spans_in_one_text():
    net = S.trained()
    rng = np.random.default_rng(3)
    parts = [rng.bytes(16).hex() if k % 2 else "ghp_" + rng.bytes(20).hex().replace("0", "Q") for k in range(40_000)]
    text = " ".join(parts)
    begun = time.process_time()
    got = S.spans(text, net)
    assert time.process_time() - begun < 60                  # the quadratic scan took over 20 minutes
    assert sum(k == 2 for _, k, _ in got) >= 20_000 and [x for x in got if x[1] < 3] == base(text)
    few = " ".join(parts[:40])
    assert S.spans(few, net)[:30] == got[:30]


def test_scores_and_clashing_names(spark):
    net = S.trained()
    text = "use ghp_9aB3xK2mQ7wE5rT1yU8iO4pL6zX0cV2bN4mA or password = abcdef77"
    docs = spark.createDataFrame([(1, text, "a", 9), (None, None, "b", None), (1, text, "a", 9), (2, "", "c", 0)],
                                 "doc_id long, text string, spans string, scores long")
    rows = S.scan(docs).collect()
    assert len(rows) == 4
    for r in rows:
        assert len(r.scores) == len([x for x in r.spans.split(",") if x]) == (2 if r.doc_id == 1 else 0)
        assert all(p >= net.threshold for p, x in zip(r.scores, r.spans.split(",")) if x.startswith("model"))
    out = S.redact(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.select("doc_id", "spans", "scores").collect())) == \
        sorted(map(str, docs.select("doc_id", "spans", "scores").collect()))
