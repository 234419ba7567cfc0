"""Every named query against its SQL; at the smallest scale unless TEST_SF_DIR says otherwise."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tickloom.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    found = differences(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert [f for f in found if f != "no rows"] == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
