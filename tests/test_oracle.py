"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
import oracle

_SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    difference = oracle.compare(entry.queries()[name](spark, sf_dir), con, _SQL[name])
    assert difference is None, difference


def test_every_query_has_sql():
    assert set(entry._QUERIES) <= set(_SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
