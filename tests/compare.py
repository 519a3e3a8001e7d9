"""Runs registered queries beside their SQL and compares the results value by value."""
from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def sql_rows(con, sql):
    done = con.execute(sql)
    return rows_of([d[0] for d in done.description], done.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} and {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} and {len(right[1])} rows"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{[(c, x, y) for c, x, y in zip(left[0], a, b) if x != y]} in {str(a)[:300]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", "/tmp/w/warehouse").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    con = connect(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            got = spark_rows(entry.queries()[name](spark, sf_dir))
            took = time.time() - start
            sql = entry.oracle_sql().get(name)
            problem = difference(got, sql_rows(con, sql)) if sql else "no SQL"
            print(f"{'ok ' if not problem else 'BAD'} {name} {len(got[1])} rows {took:.1f}s {problem or ''}"[:700], flush=True)
        except Exception as error:
            print(f"ERR {name} {type(error).__name__} {str(error)[:900]}", flush=True)
