"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from chorale.oracles import all_sql
from chorale.registry import all_queries

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 4
