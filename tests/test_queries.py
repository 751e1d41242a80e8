"""Every registered query with SQL equals its SQL, value for value."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_SQL)))
def test_query_matches_sql(spark, sql, name):
    df = entry.queries()[name](spark, SMALL)
    ok, message = compare(df, sql, entry.oracle_sql()[name])
    assert ok, message


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[:4] == ["ESN", "operator", "ACID", "ENGPOS"]
