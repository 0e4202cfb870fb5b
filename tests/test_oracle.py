"""Every registered query against its SQL."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from diamondlake.plans.queries import QUERIES

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, small, connection, name):
    assert difference(entry.queries()[name](spark, small), connection, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 12
