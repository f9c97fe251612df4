"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakestay.registry import REGISTRY
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(REGISTRY) - set(oracle_sql()) == set()
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert slow not in plan
    difference = compare(duck, df, oracle_sql()[name])
    assert difference is None, difference


def test_entry(spark):
    df = entry(spark)
    assert "confirmed_revenue_usd" in df.columns and df.count() > 0
