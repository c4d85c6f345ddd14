"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_compare import compare, oracle_connection

import __spark_entry__ as entry_point
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = entry_point.queries()[name](spark, FOLDER)
    assert compare(frame, connection, entry_point.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
