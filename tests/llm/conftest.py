import random

import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents():
    """Rows with every awkward case: nulls, empty and blank texts, one word, a
    very long text, exact copies, near copies, shared passages, repeated rows,
    null ids and sources."""
    rng = random.Random(5)
    passage = " ".join(words(rng, 60))
    base = words(rng, 200)
    texts = [None, "", " \t\n ", "one", "two words", "  nbsp éß \U0001f600 漢字",
             " ".join(words(rng, 30_000, 5_000)), " ".join(["Heat"] * 300)]
    texts += [" ".join(base)] * 3
    for k in range(6):
        near = list(base)
        for _ in range(k + 1):
            near[rng.randrange(len(near))] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(near))
    for _ in range(8):
        texts.append(" ".join(words(rng, rng.randrange(1, 90))) + "\n" + passage + " " + " ".join(words(rng, 40)))
    texts += [" ".join(words(rng, rng.randrange(1, 120))) for _ in range(40)]
    texts.append('token = "0123456789abcdef0123456789abcdef" and AKIA' + "B" * 16 + " end password: short1")
    rows = [(i, t, "en", [None, "b", "a", "é"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[8])                                            # a repeated row
    rows.append((None, "no id here", None, None, None))
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    """The documents with extra columns whose names clash with the operators' own."""
    extra = [(*r, 1, 2, 3, 4) for r in documents()]
    return spark.createDataFrame(extra, DOCS + ", node int, score int, text_hash int, _text int").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def by_id(df):
    """Rows by doc_id; of repeated ids the rows must agree."""
    out = {}
    for r in df.collect():
        d = r.asDict()
        assert out.setdefault(d["doc_id"], d) == d
    return out
