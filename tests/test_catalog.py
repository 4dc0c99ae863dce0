"""Every registered query against its SQL oracle (DuckDB) on sf0.001, and
the driver contract of ``__spark_entry__``."""
import pytest

from flowline.plans.catalog import ORACLE, QUERIES
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_parity(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0 and len(df.columns) > 0


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "n_rows", "accuracy"] and len(rows) > 0
    assert set(E.oracle_sql()) <= set(E.queries())
