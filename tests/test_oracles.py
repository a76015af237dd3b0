"""Every registered query against its DuckDB oracle, on the smallest generated tables."""

import os

import pytest

from testbed.bindings import queries
from testbed.compare import difference
from testbed.oracles import oracle_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


# Operators that would pair everything with everything, or leave the JVM.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no generated tables")
@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_oracle(spark, name):
    df = queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [x for x in UNWANTED if x in plan] == []
    assert difference(df, SF_DIR, name) is None
