"""Every registered query against its SQL on the smallest tables."""

import pytest
from comparing import database, difference

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
