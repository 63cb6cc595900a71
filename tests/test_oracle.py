"""Every registered query against its SQL counterpart, rows and types."""

import re

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def _no_cross_join(df):
    """No product of tables; a nested loop only against the one row of a total."""
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text
    assert text.count("BroadcastNestedLoopJoin") <= len(re.findall(r"Aggregate\(keys=\[\]", text))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    assert compare(df, duck, ORACLES[name]) is None
    _no_cross_join(df)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0
    _no_cross_join(df)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "instruction", "output"]
