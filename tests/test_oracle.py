"""Every registered query against its SQL oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

FOLDER = os.environ.get("LAKEWARDEN_TEST_DIR", "/root/testdata/sf0.001")
# The optional subpackage tests its own queries.
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM_ORACLES}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    planned = []

    def run(session, folder):
        planned.append(QUERIES[name](session, folder))
        return planned[0]

    result, _ = compare(spark, con, FOLDER, name, run, ORACLES.get(name))
    assert result.startswith("ok"), result
    plan = planned[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "week" in df.columns
