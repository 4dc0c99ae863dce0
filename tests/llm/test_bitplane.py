import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowline.llm import bitplane as B
from flowline.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=300), st.sampled_from([1, 8]))
@settings(max_examples=40, deadline=None)
def test_block_round_trip(ids, unit):
    x = np.array(ids, np.uint32)
    assert (B.unpack_block(B.pack_block(x, unit)) == x).all()


@given(st.binary(max_size=60), st.binary(max_size=60))
@settings(max_examples=60, deadline=None)
def test_crc_join(a, b):
    assert B.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@given(st.text(alphabet="ab1' \n\t  é\x1c<|>.", max_size=30))
@settings(max_examples=200, deadline=None)
def test_pieces_keep_the_ids(text):
    coder = B.Encoder.of(PATH)
    assert "".join(B.pieces(text)) == text
    want = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode([text])[0], np.uint32).tolist() == want


def test_special_string_and_plain_library():
    t = Tokenizer.from_file(PATH)
    for text in ("<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y  z"):
        assert np.frombuffer(B.Encoder.of(PATH).encode([text])[0], np.uint32).tolist() == \
            t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("block", [65_536, 100])
def test_written_documents_read_back(spark, docs, block):
    path = scratch_path(spark, "test_ids")
    B.write_ids(docs, path, PATH, block=block)
    t = Tokenizer.from_file(PATH)
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in B.digest(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    parts = B.read_ids(spark, path).orderBy("shard", "doc", "block").collect()
    assert sum(len(p.content) for p in parts) == 4 * start


def test_empty_table(spark, no_docs):
    path = scratch_path(spark, "test_ids")
    B.write_ids(no_docs, path, PATH)
    assert B.digest(spark, path).count() == 0


def test_cut_as_the_pieces_in_order():
    """Texts cut by Arrow, many at once, give the pieces of each alone."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab  \n'é\x1c") for _ in range(rng.randrange(0, 12))) for _ in range(400)]
    texts += [None, "", "one", " lead", "end ", "the same words\nthe same words", "a b", "two  spaces", "a\x1c b"]
    some, places = B.Encoder.of(PATH).cut(texts)
    assert [[some[k] for k in p.tolist()] for p in places] == [B.pieces(t) if t else [] for t in texts]
    some, places = B.Encoder.of(PATH).cut(["the same words the same words"] * 50)
    assert len(some) == 53                  # every text's own first piece, the others once


def test_two_generations_of_pieces(monkeypatch):
    monkeypatch.setattr(B, "CACHE", 4)
    one, t = B.Encoder(PATH), Tokenizer.from_file(PATH)
    for text in ("a few words here", "other words there and here", "words few", "a\n b  c", "a few words here"):
        for texts in ([text], [text, None, text + " more"]):
            assert [np.frombuffer(x, np.uint32).tolist() for x in one.encode(texts)] == \
                [t.encode(x or "", add_special_tokens=False).ids for x in texts]
