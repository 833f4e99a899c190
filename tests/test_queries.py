"""Every registered query against its checking SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as driver

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, duck, name):
    result = QUERIES[name](spark, small)
    assert compare.type_difference(result, duck, SQL[name]) == {}
    assert compare.difference(result, duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_every_sql_has_a_query():
    assert not set(SQL) - set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
