"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from tablegate.plans.registry import QUERIES
from oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, connection, name):
    frame = driver.queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert step not in plan
    assert difference(frame, connection, driver.oracle_sql()[name]) is None


def test_entry_runs(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["o_orderkey", "o_totalprice", "ds"]
    assert frame.count() > 0
