"""Every registered query against its SQL on the shared tables."""

import pytest

import __spark_entry__ as entry
from checks import queries as registry
from checks.compare import differences, duck

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, sf_dir, key):
    got = QUERIES[key](spark, sf_dir).toArrow()
    assert differences(got, con.sql(SQL[key]).to_arrow_table()) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
