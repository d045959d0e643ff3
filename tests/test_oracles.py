"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import difference, oracle
from deckmill.catalog import registered

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query for name, (query, _) in registered().items()}
SQL = {name: sql for name, (_, sql) in registered().items() if sql}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        assert difference(got, con.execute(SQL[name]).df()) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
