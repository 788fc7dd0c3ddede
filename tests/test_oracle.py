"""Every registered query against DuckDB on the same files."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_gives_rows_without_sql(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
