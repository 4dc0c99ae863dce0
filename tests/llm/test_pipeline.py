import re

import pytest

import corpus_pipeline as P
from flowline.llm import queries
from tests.llm import test_hyperminhash as near
from tests.llm.conftest import SMALL


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output on the small tables."""
    from flowline.llm.common import staged, table
    docs, out = table(spark, SMALL, "documents"), {}
    for name, stage in P.STAGES:
        result = staged(stage(spark, docs, SMALL), "test_pipeline")
        out[name] = (docs, result)
        docs = result
    return out


def test_order_and_columns(spark, stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "secrets", "mixing", "pieces"]
    columns = stages["toxicity"][0].columns
    assert all(out.columns == columns for name, (_, out) in stages.items() if name != "pieces")


def test_toxicity_drops_what_it_rejects(spark, stages):
    from flowline.llm import toxicity
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    clean = {r.doc_id for r in toxicity.score_documents(before, labels).collect() if not r.predicted}
    assert {r.doc_id for r in after.collect()} == clean


def test_one_of_each_near_group_stays(stages):
    before, after = stages["near_dedup"]
    want = near.brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(k for k, v in want.items() if v[1] == k)


def test_secrets_go_and_documents_stay(stages):
    before, after = stages["secrets"]
    assert before.count() == after.count()
    assert not [r.doc_id for r in after.collect() if re.search("[0-9a-f]{24}", r.text or "")]


def test_mix_and_pieces(stages):
    from flowline.llm import mixing
    before, after = stages["mixing"]
    want = {r.doc_id: r.taken for r in mixing.mix(before).collect() if r.taken}
    got: dict = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.encode().split())
    assert got == want
    last = stages["pieces"][1].collect()
    assert len(last) == after.count() and all(r.round_trip for r in last)


def test_registered():
    names = set(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.ORACLE) <= names


def test_package_guard():
    import __spark_entry__ as e
    assert "pipeline" in e.queries() and "op1_htmlcrf" in e.queries()


def test_sql_is_text():
    import __spark_entry__ as e
    assert all(isinstance(sql, str) for sql in e.oracle_sql().values())
    assert set(queries.ORACLE) == {"op6_voronoi", "op8_mixing", "op13_cascade"}
