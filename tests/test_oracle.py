"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if op in plan]
    got = df.toArrow()
    if name in SQL:
        assert compare(got, con.sql(SQL[name]).to_arrow_table()) is None
    else:
        assert got.num_rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
