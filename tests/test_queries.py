"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from adloom.queries import base
from compare import difference, duck

QUERIES = {name: build for name, build in entry.queries().items() if name in base.QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in base.ORACLES}


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, con):
    assert difference(QUERIES[name](spark, data), con, ORACLES[name]) is None


def test_entry_is_the_flagship(spark, data):
    assert "media_format" in entry.entry(spark).columns
