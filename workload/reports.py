"""Reporting aggregates."""
from pyspark.sql import functions as F

from sluicebox.operators import columns, report, validate
from workload.registry import LINES, ORDERS, query, table, union_all

_LINE_COLUMNS = list(LINES.columns)


@query(
    "missing_counts",
    union_all(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM ({LINES.sql}) HAVING count({c}) < count(*)"
        for c in _LINE_COLUMNS if c != "ship_year"
    ),
)
def missing_counts(spark, sf_dir):
    """Gaps in the year column are structural and not listed."""
    return report.missing_counts(LINES.frame(spark, sf_dir))


@query(
    "null_percent",
    union_all(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS null_percent FROM ({LINES.sql})"
        for c in _LINE_COLUMNS
    ),
)
def null_percent(spark, sf_dir):
    return report.null_percent(LINES.frame(spark, sf_dir))


@query(
    "headline",
    f"SELECT count(*) AS rows, cast({len(_LINE_COLUMNS)} AS bigint) AS columns, cast("
    + " + ".join(f"count(*) - count({c})" for c in _LINE_COLUMNS) + f" AS bigint) AS missing FROM ({LINES.sql})",
)
def headline(spark, sf_dir):
    return report.headline(LINES.frame(spark, sf_dir))


def _describe_words(c, source):
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS count, count(DISTINCT {c}) AS \"unique\", "
        f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM {source} GROUP BY 1) WHERE v IS NOT NULL ORDER BY n DESC, v LIMIT 1) AS top, "
        f"(SELECT max(n) FROM (SELECT count({c}) AS n FROM {source} GROUP BY {c})) AS freq, "
        "NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q25, NULL::DOUBLE AS q50, "
        f"NULL::DOUBLE AS q75, NULL::DOUBLE AS max FROM {source}"
    )


def _describe_numbers(c, source):
    return (
        f"SELECT '{c}', count({c}), NULL, NULL, NULL, round(avg({c}), 4), round(stddev_samp({c}), 4), "
        f"cast(min({c}) AS DOUBLE), quantile_cont({c}, 0.25), quantile_cont({c}, 0.5), quantile_cont({c}, 0.75), "
        f"cast(max({c}) AS DOUBLE) FROM {source}"
    )


def _rounded(df):
    return df.select(*[F.round(c, 4).alias(c) if c in ("mean", "std") else F.col(c) for c in df.columns])


@query(
    "describe_customer",
    union_all([
        *[_describe_words(c, "customer") for c in ("c_name", "c_mktsegment")],
        *[_describe_numbers(c, "customer") for c in ("c_custkey", "c_nationkey")],
        _describe_numbers("c_acctbal", "customer").replace("quantile_cont(c_acctbal, 0.25)", "round(quantile_cont(c_acctbal, 0.25), 4)")
        .replace("quantile_cont(c_acctbal, 0.5)", "round(quantile_cont(c_acctbal, 0.5), 4)")
        .replace("quantile_cont(c_acctbal, 0.75)", "round(quantile_cont(c_acctbal, 0.75), 4)"),
    ]),
)
def describe_customer(spark, sf_dir):
    df = _rounded(report.describe(table(spark, sf_dir, "customer")))
    return df.select(*[F.round(c, 4).alias(c) if c in ("q25", "q50", "q75") else F.col(c) for c in df.columns])


@query(
    "preview",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10",
)
def preview(spark, sf_dir):
    """The first ten rows, which is what a preview is."""
    return columns.preview(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), 10, "o_orderkey")


@query(
    "table_shape",
    union_all(
        f"SELECT '{t}' AS name, count(*) AS rows, cast({n} AS bigint) AS columns FROM {t}"
        for t, n in {"orders": 6, "lineitem": 11, "documents": 5, "pages": 3, "embeddings": 3, "labels": 3, "supplier": 4, "region": 2, "nation": 3, "benchmark": 2}.items()
    ),
)
def table_shape(spark, sf_dir):
    names = ["orders", "lineitem", "documents", "pages", "embeddings", "labels", "supplier", "region", "nation", "benchmark"]
    rows = [(n, *columns.shape(table(spark, sf_dir, n))[0]) for n in names]
    return spark.createDataFrame(rows, "name string, rows bigint, columns bigint")


_VALID = "SELECT 'orders' AS dataset, {check} AS \"check\", {status} AS status, {metric}::DOUBLE AS metric FROM ({source})"


def _checks_sql():
    source = ORDERS.sql
    texts = ["customer", "comment"]
    parts = [
        _VALID.format(check="'non_empty'", status="CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END", metric="count(*)", source=source),
        _VALID.format(check="'schema_match'", status="'FAIL'", metric="1", source=source) + " HAVING count(*) > 0",
        _VALID.format(
            check="'deduplication'", status="CASE WHEN count(*) = count(DISTINCT order_key) THEN 'PASS' ELSE 'FAIL' END",
            metric="count(*) - count(DISTINCT order_key)", source=source,
        ),
        _VALID.format(check="'no_nulls'", status="'FAIL'", metric="2 * count(*) - count(customer) - count(comment)", source=source),
        _VALID.format(check="'row_drop_ratio'", status="'PASS'", metric="0.2", source=source) + " HAVING count(*) > 0",
    ]
    parts += [
        _VALID.format(check=f"'unexpected_nulls_{c}'", status="'FAIL'", metric=f"count(*) - count({c})", source=source)
        + f" HAVING count({c}) < count(*)" for c in texts
    ]
    return union_all(parts)


@query("validate_checks", _checks_sql())
def validate_checks(spark, sf_dir):
    """A table with gaps, a lost column and a fifth fewer rows than before."""
    from sluicebox.operators.dedup import DedupStatus

    df = ORDERS.frame(spark, sf_dir)
    schema = {c: "text" for c in df.columns} | {"lost": "text"}
    before = int(df.count() * 1.25)
    done = validate.validate(df, "orders", schema, DedupStatus(executed=True, keys=["order_key"]), before)
    return done.as_frame(spark).select("dataset", "check", "status", F.round("metric", 4).alias("metric"))


@query(
    "null_ratio_check",
    union_all(
        f"SELECT '{c}' AS \"column\", 1 - count({c})::DOUBLE / count(*) AS null_ratio FROM ({LINES.sql}) HAVING 1 - count({c}) / count(*) > 0.3"
        for c in _LINE_COLUMNS if c != "ship_year"
    ),
)
def null_ratio_check(spark, sf_dir):
    found = validate.null_ratio_check(LINES.frame(spark, sf_dir))
    df = spark.createDataFrame(list(found.items()), "column string, null_ratio double")
    return df


@query(
    "year_end_notice",
    "SELECT 'year_made_end' AS \"column\" FROM orders HAVING count(*) FILTER (WHERE o_orderkey % 4 = 0) > 0",
)
def year_end_notice(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "year(o_orderdate) AS year_made",
        "CASE WHEN o_orderkey % 4 <> 0 THEN year(o_orderdate) + 1 END AS year_made_end",
        "CASE WHEN o_orderkey % 4 <> 0 THEN year(o_orderdate) END AS other_end",
    )
    return spark.createDataFrame([(c,) for c in report.year_end_notice(df)], "column string")
