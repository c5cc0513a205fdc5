"""Each query against its SQL on DuckDB, and against rules for its plan."""

import pytest

import __spark_entry__ as entry
from check import connect, differences
from lakemill.catalogue import ORACLES, QUERIES

from .conftest import SMALL

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name in ORACLES:
        problem = differences(df, duck, ORACLES[name])
        assert problem is None, problem
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
