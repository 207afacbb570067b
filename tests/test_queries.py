"""Every query against its SQL oracle on the small tables."""

import os

import pytest
from oracle import connect, duck_rows, spark_rows

import __spark_entry__ as entry
from parcelflow.plans.oracles import ORACLES
from parcelflow.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert spark_rows(result) == duck_rows(duck, ORACLES[name])
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval"):
        assert operator not in plan


def test_entry_is_lazy_and_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
