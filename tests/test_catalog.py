"""Every query with an SQL twin against DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from compare import differences, open_tables  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, tables, name):
    assert differences(queries()[name](spark, FOLDER), tables, oracle_sql()[name]) == []


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and sum(r["users"] for r in rows) > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
