import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowline.llm import anchors as N

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["▁", "a ▁ b", "<|endoftext|> x <s> </s> <unk> <0x41>", " lead  two   three ", "tab\tnew\nline\r\n", "日本語 テキスト",
       "\U0001f600\U0001f600 ok", "\x00 nul", "é́ ﬁ ½", "a" * 5000, " " * 12_000 + "end", "1234567 12 3", "don't we'll"]


def found(df):
    rows = N.aligned(df, A, B).withColumn(
        "groups_sha256", F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256))).drop("groups")
    return sorted((tuple(r) for r in N.scored(rows, A, B).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()),
        key=lambda r: (r[0] is not None, *map(str, r)))


def expected(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    return sorted(N.brute_force(rows, A, B), key=lambda r: (r[0] is not None, *map(str, r)))


def test_documents_equal_brute_force(docs):
    assert found(docs) == expected(docs)


def test_small_table_equals_brute_force(spark):
    out = {r.doc_id: tuple(r) for r in N.op11_anchors(spark, "/root/testdata/sf0.001").collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert out == {r[0]: r for r in N.brute_force(rows, A, B)}


def test_odd_texts(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").repartition(3)
    rows = found(df)
    assert rows == expected(df)
    assert [r[1:] for r in rows if r[0] == 0] == [(0, 0, 0, 0, 0, 0, "")]          # the mark itself is no space
    assert all(r[1] for r in rows if r[0] not in (0, 1))


def test_hot_repeated_rows(spark):
    df = spark.createDataFrame([(7, "the same words again and again")] * 300 + [(8, None), (9, "")],
                               "doc_id long, text string").repartition(5)
    rows = found(df)
    assert len(rows) == 302 and len(set(rows)) == 3 and rows == expected(df)
    same = next(r for r in rows if r[0] == 7)
    assert same[4] == same[5] and same[6] >= 300 * same[4]


def test_small_memo_and_portions(spark, monkeypatch):
    monkeypatch.setattr(N, "CACHE", 3)
    one = N.Aligner(A, B)
    texts = ["some words here", None, "other words there", "", "some words there", "x " * 500]
    whole = [N.Aligner.of(A, B).align([t])[0] for t in texts]
    assert [one.align([t])[0] for t in texts] == whole == one.align(texts)


@given(st.text(alphabet="ab1' \n\té日▁.", max_size=40))
@settings(max_examples=60, deadline=None)
def test_any_text(text):
    _, n_a, n_b, groups, links = (N.brute_force([(1, text)], A, B)[0][k] for k in range(5))
    got = N.Aligner.of(A, B).align([text])[0]
    assert (got[0], got[1], got[2].count("|"), len(got[3]) // 4) == (n_a, n_b, groups, links)


@pytest.mark.parametrize("ranked", [True, False])
def test_both_ways_of_encoding(ranked):
    from tokenizers import Tokenizer
    one, library = N.ByteBpe(A), Tokenizer.from_file(A)
    library.encode_special_tokens = True
    assert one.ranked is not None
    if not ranked:
        one.ranked = None
    assert one.encode(ODD) == [library.encode(t, add_special_tokens=False).ids for t in ODD]


def test_linkable_pairs_bound():
    a, b = [b"ab", b"b", b"", b"cab"], [b"b", b"xb", b"ab", b"b"]
    assert N.linkable(a, b) == [(0, 0), (0, 2), (0, 3), (1, 0), (1, 1), (1, 2), (1, 3), (3, 0), (3, 2), (3, 3)]
    one = N.Aligner.of(A, B)
    assert len(one.pairs) <= 2 * (one.a_size.sum() + one.b_size.sum()) and (np.diff(one.pairs) > 0).all()


def test_empty_table(no_docs):
    assert found(no_docs) == []


def test_bytes_are_joined_many_texts_at_once():
    one = N.Aligner.of(A, B)
    texts = ["the first", "é日 second\n", "x"]
    for coder, words in ((one.a, one.a_words), (one.b, one.b_words)):
        ids = coder.encode([*texts, ""])
        packed, said = one._said(words, ids)
        assert [x.tolist() for x in packed] == ids
        assert said == [b"".join(coder.bytes[i] for i in x) for x in ids]
    assert one._said(one.a_words, [])[1] == [] and one._said(one.a_words, [[], []])[1] == [b"", b""]
