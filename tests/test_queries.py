"""Every query against its SQL twin on the smallest tables."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as entry
from aerolake.checks.oracle import all_sql
from aerolake.checks.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert compare(frame, connection, SQL[name]) is None
    else:
        assert frame.count() > 0


def test_only_file_sizes_lack_sql():
    assert set(QUERIES) - set(SQL) == {"storage_report"}


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
