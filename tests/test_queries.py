"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_file
from agentlake.plans import load_all
from agentlake.plans.check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = load_all()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, message, _ = compare(spark, con, SF, name, QUERIES[name], ORACLE.get(name))
    assert ok, message


def test_entry(spark):
    assert entry_file.entry(spark).limit(1).count() == 1
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_filters_reach_the_scan(spark):
    plan = QUERIES["p4_as_of_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_shipdate" in plan
