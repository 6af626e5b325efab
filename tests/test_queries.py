"""Every registered query against its SQL in DuckDB, and what its plan must not contain."""

from __future__ import annotations

import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from registry.queries import QUERIES
from tools.check import connect, normal

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "InPandas")


@pytest.fixture(scope="module")
def duck():
    return connect(TESTDATA)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, TESTDATA)
    ours = normal([tuple(r) for r in df.collect()], df.columns)
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert ours == normal(result.fetchall(), names)
    assert ours, "the query gives no rows"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]


def test_entry(spark):
    assert entry.entry(spark).columns == ["sector", "test_size", "actual_left", "predict_left"]
