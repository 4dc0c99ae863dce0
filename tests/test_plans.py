"""Plan-level guarantees: no cartesian / nested-loop joins in any registered
query, map-side lookups are broadcast, scans read pruned schemas."""
import re

import pytest
from pyspark.sql import functions as F

from flowline.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
LONG = {"parallel_trials", "sequential_trials", "checkpoint_resume", "distributed_fit"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_no_cross_products(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_label_lookup_is_broadcast_and_pruned(spark):
    plan = _plan(QUERIES["label_index_join"](spark, SF))
    assert "BroadcastHashJoin" in plan
    for schema in re.findall(r"ReadSchema: (struct<[^\]]*?>)", plan):
        assert "value" not in schema and "props" not in schema      # unused columns not read


def test_scoring_is_arrow_batched(spark):
    plan = _plan(QUERIES["score_table"](spark, SF))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan
