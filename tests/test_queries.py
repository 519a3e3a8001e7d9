"""Every registered query against its SQL on the smallest tables."""
import pytest

import __spark_entry__ as entry
from workload import QUERIES, SQL
from tests.compare import connect, difference, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = spark_rows(QUERIES[name](spark, SF_DIR))
    assert difference(got, sql_rows(con, SQL[name])) is None
