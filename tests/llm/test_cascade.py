import itertools
import random
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowline.llm import cascade as Q

WHITE = " \t\n\v\f\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cut(text):
    out, word = [], ""
    for c in text:
        if c in WHITE:
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out + [word] * bool(word)


def plain(text):
    """The measures and the verdict, written out."""
    text = text or ""
    words = cut(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    held = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if cut(x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    chars, n = sum(map(len, words)), len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    kept = not (n < 50 or len(held) > n / 2 or symbols > n / 10 or dup > len(lines) / 2
                or not 2 <= chars / n <= 15 or upper > lower or text.count("!") > n / 3)
    return n, chars, symbols, dup, len(held), kept


@given(st.lists(st.sampled_from(["a", "b", "né", "漢", " ", "\n", "\t", "#", "!", "A", "\x1c", " "]), max_size=60).map(" ".join)
       | st.text(alphabet="ab \n#é", max_size=60))
@settings(max_examples=200, deadline=None)
def test_measures(text):
    doc = Q.Doc(text)
    assert (*(getattr(doc, m) for m in MEASURES), not any(r.fails(doc) for r in Q.RULES)) == plain(text)


def test_documents_equal_brute_force(docs):
    texts = docs.select("doc_id", "text").collect()
    got = Q.quality(docs, measures=MEASURES).collect()
    assert sorted(((r.doc_id, *(r[m] for m in MEASURES), r.kept) for r in got), key=str) == \
        sorted(((r.doc_id, *plain(r.text)) for r in texts), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    rows = con.execute(Q.oracle_sql()).fetchall()
    assert sorted(rows) == sorted(tuple(r) for r in Q.op13_cascade(spark, d).collect())


def test_every_order_gives_the_verdicts(small):
    rules = Q.RULES[:4]
    want = None
    for order in itertools.islice(itertools.permutations(rules), 0, 24, 7):
        rows = Q.cascade(small, order).collect()
        kept = sorted((r.doc_id, r.kept) for r in rows)
        want = want or kept
        assert kept == want
        for r in rows:                                        # short circuit: what ran ends with what failed
            assert r.rules_run == len(order) if r.kept else order[r.rules_run - 1].name == r.failed_rule


def test_order_by_rejections_per_cost(spark):
    df = spark.createDataFrame([("dear", 10, 5, 1_000_000), ("cheap", 10, 4, 1_000), ("idle", 10, 0, 10), ("all", 10, 10, 2_000)],
                               "rule string, n long, rejected long, cpu_ns long")
    rules = [Q.Rule(n, lambda d: False) for n in ("unseen", "dear", "idle", "all", "cheap")]
    assert [r.name for r in Q.ordered(rules, df)][:3] == ["all", "cheap", "dear"]


def test_estimates_from_the_sample(spark, small):
    found = {r.rule: r for r in Q.estimates(small, sample_rows=10 ** 6).collect()}
    texts = [r.text for r in small.collect()]
    assert set(found) == {r.name for r in Q.RULES}
    for rule in Q.RULES:
        r = found[rule.name]
        assert r.n == len(texts) and r.rejected == sum(rule.fails(Q.Doc(t)) for t in texts) and r.cpu_ns > 0


def test_clean_documents_stay(spark):
    """Of labelled documents all bad ones go; good ones go by the base rules alone."""
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    rows = Q.op13_cascade(spark, d).join(labels, "doc_id").collect()
    assert not any(r.kept for r in rows if r.quality == 0)
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)


def test_long_hot_and_empty(spark, no_docs):
    assert Q.quality(no_docs).count() == 0
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(10 ** 7)}" for _ in range(150_000))
    df = spark.createDataFrame([(1, text), (None, None)] + [(2, "x y z")] * 300, "doc_id long, text string").repartition(4)
    rows = Q.quality(df, measures=("n_words", "n_repeat_words")).collect()
    assert len(rows) == 302
    long = next(r for r in rows if r.doc_id == 1)
    assert long.n_words == 150_000 and long.kept and long.n_repeat_words == 0


def test_many_different_words():
    """More words than fit three to a number are ranked by pairs."""
    words = [f"{k}" for k in range(2_100_000)]
    doc = Q.Doc(" ".join([*words, *words[:3]]))
    assert doc.n_repeat_words == 6
