"""Queries that SQL can express, against DuckDB on the smallest tables."""
import pytest

from sluicebox.llm.queries import QUERIES, SQL
from tests.compare import connect, difference, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    got = spark_rows(QUERIES[name](spark, SF_DIR))
    assert difference(got, sql_rows(connect(SF_DIR), SQL[name])) is None
