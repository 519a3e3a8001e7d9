"""Duplicate rows."""
from pyspark.sql import functions as F

from sluicebox.operators import dedup
from sluicebox.operators.schema import detect_schema
from workload.registry import query, table

_KEYS = ["l_orderkey", "l_linenumber"]
_ALL = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


def _one_sql(order: str, test: str = "rn = 1") -> str:
    return (
        "SELECT * EXCLUDE (rn, n, l_shipdate), strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM (SELECT *, "
        f"row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn, "
        f"count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE {test}"
    )


def _shown(df):
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def _order():
    return F.struct(*[c.strip() for c in _ALL.split(",")])


_DESCENDING = ", ".join(f"{c.strip()} DESC" for c in _ALL.split(","))


@query("dedup_keep_first", _one_sql(_ALL))
def dedup_keep_first(spark, sf_dir):
    return _shown(dedup.keep_one(table(spark, sf_dir, "lineitem"), _KEYS, "first", _order()))


@query("dedup_keep_last", _one_sql(_DESCENDING))
def dedup_keep_last(spark, sf_dir):
    return _shown(dedup.keep_one(table(spark, sf_dir, "lineitem"), _KEYS, "last", _order()))


@query("dedup_keep_none", _one_sql(_ALL, "n = 1"))
def dedup_keep_none(spark, sf_dir):
    return _shown(dedup.keep_one(table(spark, sf_dir, "lineitem"), _KEYS, False, _order()))


@query("dedup_guarded", _one_sql(_ALL))
def dedup_guarded(spark, sf_dir):
    """About a quarter of the lines repeat order and line number, which the guard lets pass."""
    return _shown(dedup.remove_duplicates(table(spark, sf_dir, "lineitem"), _KEYS, order_by=_order()).df)


@query("dedup_aborted", "SELECT * FROM orders")
def dedup_aborted(spark, sf_dir):
    """One order per customer would drop most rows, so nothing is removed."""
    return dedup.remove_duplicates(table(spark, sf_dir, "orders"), ["o_custkey"]).df


@query(
    "dedup_status",
    "SELECT 'lineitem' AS name, true AS executed, false AS aborted, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed "
    "FROM lineitem UNION ALL SELECT 'orders', false, count(DISTINCT o_custkey) < 0.7 * count(*), 0 FROM orders "
    "UNION ALL SELECT 'events', false, false, 0 FROM events GROUP BY 1",
)
def dedup_status(spark, sf_dir):
    runs = {
        "lineitem": dedup.remove_duplicates(table(spark, sf_dir, "lineitem"), _KEYS, order_by=_order()).status,
        "orders": dedup.remove_duplicates(table(spark, sf_dir, "orders"), ["o_custkey"]).status,
        "events": dedup.remove_duplicates(table(spark, sf_dir, "events"), ["no_such_column"]).status,
    }
    rows = [(name, s.executed, s.aborted, s.removed) for name, s in runs.items()]
    return spark.createDataFrame(rows, "name string, executed boolean, aborted boolean, removed bigint")


@query(
    "duplicate_count",
    "SELECT 'orders per customer' AS what, count(*) AS rows, count(DISTINCT o_custkey) AS groups, "
    "count(*) - count(DISTINCT o_custkey) AS duplicates FROM orders UNION ALL "
    "SELECT 'document texts', count(*), count(DISTINCT text), count(*) - count(DISTINCT text) FROM documents UNION ALL "
    "SELECT 'events by user and type, gaps equal', count(*), count(DISTINCT (k, event_type)), "
    "count(*) - count(DISTINCT (k, event_type)) FROM (SELECT coalesce(CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END, -1) AS k, event_type FROM events)",
)
def duplicate_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END AS k", "event_type"
    )
    parts = [
        ("orders per customer", dedup.duplicate_counts(table(spark, sf_dir, "orders"), ["o_custkey"])),
        ("document texts", dedup.duplicate_counts(table(spark, sf_dir, "documents"), ["text"])),
        ("events by user and type, gaps equal", dedup.duplicate_counts(events, ["k", "event_type"])),
    ]
    named = [df.select(F.lit(what).alias("what"), "*") for what, df in parts]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("dedup_full_row", "SELECT DISTINCT * FROM (SELECT * FROM labels UNION ALL SELECT * FROM labels WHERE doc_id % 3 = 0)")
def dedup_full_row(spark, sf_dir):
    """Whole rows, a third of them twice."""
    labels = table(spark, sf_dir, "labels")
    return dedup.drop_repeated_rows(labels.unionByName(labels.where("doc_id % 3 = 0")))


_HALF_UNIQUE = (
    "CASE WHEN count(DISTINCT {c}) > 0.3 * count(*) AND count(DISTINCT {c}) < 0.98 * count(*) THEN '{c}' END"
)


@query(
    "derive_keys",
    "SELECT 'events' AS name, 'event_id' AS keys FROM events GROUP BY 1 UNION ALL "
    f"SELECT 'lineitem', concat_ws(',', {_HALF_UNIQUE.format(c='line_ref')}, 'ship_year') FROM "
    "(SELECT concat(l_orderkey, '/', l_linenumber) AS line_ref FROM lineitem) UNION ALL "
    "SELECT 'orders', '' FROM orders GROUP BY 1",
)
def derive_keys(spark, sf_dir):
    frames = {
        "events": table(spark, sf_dir, "events"),
        "lineitem": table(spark, sf_dir, "lineitem").selectExpr(
            "concat(l_orderkey, '/', l_linenumber) AS line_ref", "l_quantity", "l_returnflag",
            "year(l_shipdate) AS ship_year",
        ),
        "orders": table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice"),
    }
    rows = [(name, ",".join(dedup.derive_keys(df, detect_schema(df)))) for name, df in frames.items()]
    return spark.createDataFrame(rows, "name string, keys string")
