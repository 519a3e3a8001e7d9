"""Where queries and their SQL are collected, and the dirt that both sides read.

The given tables are clean.  Dirt is a set of column expressions, written so
that Spark and DuckDB read the same text the same way.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Dirt:
    """A table with some columns replaced by expressions that both engines understand."""

    def __init__(self, source: str, columns: dict[str, str]):
        self.source, self.columns = source, columns

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, self.source).selectExpr(*[f"{e} AS `{c}`" for c, e in self.columns.items()])

    @property
    def sql(self) -> str:
        chosen = ", ".join(f'{e} AS "{c}"' for c, e in self.columns.items())
        return f"SELECT {chosen} FROM {self.source}"


def union_all(parts) -> str:
    return " UNION ALL ".join(parts)


# --- SQL texts of the cell rules

def sql_clean_text(e: str) -> str:
    bare = rf"regexp_replace({e}, '\[[^\]]*\]', '', 'g')"
    bare = rf"regexp_replace({bare}, '[†‡*]', '', 'g')"
    bare = rf"regexp_replace({bare}, '[\x00-\x1F\x7F]', '', 'g')"
    bare = rf"regexp_replace({bare}, '[^\x20-\x7E]', '', 'g')"
    return rf"trim(regexp_replace({bare}, '\s+', ' ', 'g'))"


MISSING_SQL = (
    "'', ' ', '  ', '   ', chr(9), chr(10), 'nan', 'NaN', 'NAN', 'null', 'NULL', "
    "'none', 'None', 'NONE', '-', '--', '—', '<NA>'"
)
CSV_MISSING_SQL = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def sql_null_missing(e: str, words: str = MISSING_SQL) -> str:
    return f"CASE WHEN {e} IN ({words}) THEN NULL ELSE {e} END"


def sql_amount(e: str) -> str:
    amount = rf"regexp_replace(trim({e}), '\[[^\]]*\]', '', 'g')"
    digits = rf"regexp_replace({amount}, '[^0-9.\-]', '', 'g')"
    suffix = rf"upper(regexp_extract({amount}, '([KMBkmb]),*$', 1))"
    scale = f"CASE {suffix} WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 ELSE 1e0 END"
    return f"(TRY_CAST({digits} AS DOUBLE) * {scale})"


def sql_years(e: str) -> str:
    return rf"regexp_extract_all({e}, '(19\d{{2}}|20\d{{2}})', 1)"


def sql_mode(value: str, source: str) -> str:
    """Most frequent value, the smallest among equally frequent ones."""
    return (
        f"(SELECT v FROM (SELECT {value} AS v, count(*) AS n FROM ({source}) GROUP BY 1) "
        "WHERE v IS NOT NULL ORDER BY n DESC, v LIMIT 1)"
    )


# --- dirt

ORDERS = Dirt("orders", {
    "order_key": "o_orderkey",
    "status": (
        "CASE o_orderkey % 11 WHEN 0 THEN '-' WHEN 1 THEN 'nan' WHEN 2 THEN '<NA>' WHEN 3 THEN '  ' "
        "WHEN 4 THEN 'Null' ELSE o_orderstatus END"
    ),
    "price": (
        "CASE o_orderkey % 5 WHEN 0 THEN concat('$', cast(floor(o_totalprice) AS bigint)) "
        "WHEN 1 THEN concat('€', cast(floor(o_totalprice / 1000) AS bigint), 'K') "
        "WHEN 2 THEN concat('£', cast(floor(o_totalprice / 1000) AS bigint), ',', 100 + o_orderkey % 900, '[a]') "
        "WHEN 3 THEN concat(' ₹', cast(floor(o_totalprice / 100000) AS bigint), '.5m ') "
        "ELSE concat('n.a. ', o_orderstatus) END"
    ),
    "years": (
        "CASE WHEN o_orderkey % 4 = 0 THEN concat(year(o_orderdate), '') "
        "WHEN o_orderkey % 4 = 1 THEN concat(year(o_orderdate), year(o_orderdate) + 1) "
        "ELSE concat(year(o_orderdate), '–', year(o_orderdate) + 1) END"
    ),
    "priority": "concat('  ', o_orderpriority, chr(9))",
    "customer": "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END",
    "comment": "CAST(NULL AS string)",
})

LINES = Dirt("lineitem", {
    "order_key": "l_orderkey",
    "line": "l_linenumber",
    "quantity": "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END",
    "price": "CASE WHEN l_orderkey % 997 = 0 THEN l_extendedprice * 100 ELSE l_extendedprice END",
    "tax": "CASE WHEN l_partkey % 10 < 9 THEN NULL ELSE l_tax END",
    "flag": "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END",
    "ship_year": "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE cast(year(l_shipdate) AS int) END",
    "discount_text": "CASE WHEN l_orderkey % 6 = 0 THEN 'none given' ELSE cast(l_discount AS string) END",
    "remark": "CAST(NULL AS string)",
})

PARTS = Dirt("part", {
    "part_key": "p_partkey",
    "label": "concat(' ', p_name, ' [', p_size, ']', chr(10), '†â€¡ ﬁne ［x］ Café *')",
    "tags": "concat(p_brand, ';', p_type, ' / ', p_name, ' , ', p_brand, ':', p_size)",
    "size": "p_size",
    "price": "p_retailprice",
    "years_made": "concat(1950 + p_size, '-', CASE WHEN p_size % 3 = 0 THEN 'now' ELSE concat(1951 + p_size, '') END)",
})
