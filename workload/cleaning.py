"""Standardising, missing cells, types and outliers."""
from pyspark.sql import functions as F

from sluicebox.operators import columns, missing, outliers, profile, report, schema, standardize
from workload.registry import (
    LINES, ORDERS, query, sql_amount, sql_clean_text, sql_mode, sql_null_missing, sql_years, table, union_all,
)

_YEARS = sql_years("replace(years, '–', '-')")
_PRICE = f"CASE WHEN {sql_amount('price')} IS NULL THEN price ELSE concat(cast({sql_amount('price')} AS bigint), '.0') END"


@query(
    "standardize_orders",
    rf"SELECT order_key, regexp_replace(status, '^\s+|\s+$', '', 'g') AS status, {_PRICE} AS price, "
    f"cast({_YEARS}[1] AS bigint) AS years, CASE WHEN len({_YEARS}) > 1 THEN cast({_YEARS}[-1] AS bigint) END AS years_end, "
    f"{sql_clean_text('priority')} AS priority, customer, comment FROM ({ORDERS.sql})",
)
def standardize_orders(spark, sf_dir):
    return standardize.standardize(ORDERS.frame(spark, sf_dir)).df


@query("drop_empty_columns", f"SELECT * EXCLUDE (remark) FROM ({LINES.sql})")
def drop_empty_columns(spark, sf_dir):
    return columns.drop_empty_columns(LINES.frame(spark, sf_dir))[0]


@query("drop_sparse_columns", f"SELECT * EXCLUDE (remark, tax) FROM ({LINES.sql})")
def drop_sparse_columns(spark, sf_dir):
    return columns.drop_sparse_columns(LINES.frame(spark, sf_dir))[0]


_FILLED_LINES = ["order_key", "line", "quantity", "price", "flag"]


@query(
    "drop_null_rows",
    f"SELECT {', '.join(_FILLED_LINES)} FROM ({LINES.sql}) WHERE quantity IS NOT NULL AND flag IS NOT NULL",
)
def drop_null_rows(spark, sf_dir):
    return missing.drop_null_rows(LINES.frame(spark, sf_dir).select(*_FILLED_LINES))


@query(
    "fill_constant",
    f"SELECT order_key, line, coalesce(quantity, 0) AS quantity, price, coalesce(flag, '0') AS flag FROM ({LINES.sql})",
)
def fill_constant(spark, sf_dir):
    return missing.fill_constant(LINES.frame(spark, sf_dir).select(*_FILLED_LINES), 0)


@query(
    "coerce_numeric_like",
    f"SELECT order_key, line, flag, TRY_CAST(discount_text AS DOUBLE) AS discount_text FROM ({LINES.sql})",
)
def coerce_numeric_like(spark, sf_dir):
    df = LINES.frame(spark, sf_dir).select("order_key", "line", "flag", "discount_text")
    return missing.coerce_numeric_like(df)[0]


@query(
    "mode_values",
    "SELECT 'quantity' AS \"column\", cast(v AS string) AS mode, n FROM (SELECT quantity AS v, count(*) AS n FROM "
    f"({LINES.sql}) WHERE quantity IS NOT NULL GROUP BY 1) WHERE v = " + sql_mode("quantity", LINES.sql) +
    " UNION ALL SELECT 'price', cast(v AS string), n FROM (SELECT l_orderkey AS v, count(*) AS n FROM lineitem GROUP BY 1) "
    "WHERE v = " + sql_mode("l_orderkey", "SELECT * FROM lineitem"),
)
def mode_values(spark, sf_dir):
    """A double with few values and a key with many."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS price")
    few = profile.mode_frame(LINES.frame(spark, sf_dir), ["quantity"])
    many = profile.mode_frame(lines, ["price"])
    return few.unionByName(many).select(
        "column", F.coalesce(F.col("num").cast("string"), F.col("whole").cast("string")).alias("mode"), "n"
    )


_MODE_OF = (
    "SELECT '{c}' AS \"column\", cast({c} AS VARCHAR) AS mode, count(*) AS n FROM documents WHERE {c} IS NOT NULL "
    "GROUP BY {c} QUALIFY row_number() OVER (ORDER BY count(*) DESC, {c}) = 1"
)


@query("modes_documents", union_all([f"SELECT * FROM ({_MODE_OF.format(c=c)})" for c in ("doc_id", "text", "lang", "source", "n_chars")]))
def modes_documents(spark, sf_dir):
    """Unique ids, long texts with some copies, a language that stands out, sizes that hardly repeat."""
    found = profile.mode_frame(table(spark, sf_dir, "documents"), ["doc_id", "text", "lang", "source", "n_chars"])
    return found.select("column", F.coalesce("txt", F.col("whole").cast("string")).alias("mode"), "n")


_SEGMENTS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS segment FROM customer"


@query("impute_category", f"SELECT * REPLACE (coalesce(segment, {sql_mode('segment', _SEGMENTS)}) AS segment) FROM ({_SEGMENTS})")
def impute_category(spark, sf_dir):
    """Gaps of a column with few different values take the most frequent one."""
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS segment")
    return missing.handle_missing(raw, "auto")


@query(
    "structural_ends",
    "SELECT 'priority' AS \"column\", count(*) FILTER (WHERE o_orderkey % 4 = 0) AS missing FROM orders",
)
def structural_ends(spark, sf_dir):
    """Gaps are expected in columns named ``*_end``, whatever they hold, and reported in others."""
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS priority", "o_orderstatus", "o_totalprice",
        "CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS priority_end", "CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS price_end")
    return report.missing_counts(raw)


@query(
    "impute_mode_numeric",
    f"SELECT order_key, line, coalesce(quantity, {sql_mode('quantity', LINES.sql)}) AS quantity, "
    f"coalesce(tax, {sql_mode('tax', LINES.sql)}) AS tax, ship_year FROM ({LINES.sql})",
)
def impute_mode_numeric(spark, sf_dir):
    """Year columns keep their gaps."""
    df = LINES.frame(spark, sf_dir).select("order_key", "line", "quantity", "tax", "ship_year")
    return missing.impute(df).df


_STATUS = f"SELECT order_key, {sql_null_missing('status')} AS status FROM ({ORDERS.sql})"


@query(
    "impute_mode_text",
    f"SELECT order_key, coalesce(status, {sql_mode('status', _STATUS)}) AS status FROM ({_STATUS})",
)
def impute_mode_text(spark, sf_dir):
    return missing.impute(ORDERS.frame(spark, sf_dir).select("order_key", "status")).df


_DISCOUNT = f"SELECT TRY_CAST(discount_text AS DOUBLE) AS d FROM ({LINES.sql})"


@query(
    "impute_auto",
    f"SELECT order_key, line, coalesce(quantity, {sql_mode('quantity', LINES.sql)}) AS quantity, price, "
    f"coalesce(tax, {sql_mode('tax', LINES.sql)}) AS tax, coalesce(flag, {sql_mode('flag', LINES.sql)}) AS flag, "
    f"ship_year, coalesce(TRY_CAST(discount_text AS DOUBLE), {sql_mode('d', _DISCOUNT)}) AS discount_text "
    f"FROM ({LINES.sql})",
)
def impute_auto(spark, sf_dir):
    return missing.handle_missing(LINES.frame(spark, sf_dir), "auto")


@query(
    "impute_datetime",
    "SELECT event_id, strftime(coalesce(d, (SELECT d FROM (SELECT date_trunc('day', ts) AS d, count(*) AS n FROM events "
    "WHERE event_id % 4 <> 0 GROUP BY 1) ORDER BY n DESC, d LIMIT 1)), '%Y-%m-%d') AS day FROM "
    "(SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE date_trunc('day', ts) END AS d FROM events)",
)
def impute_datetime(spark, sf_dir):
    days = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 4 = 0 THEN NULL ELSE date_trunc('day', ts) END AS day"
    )
    return missing.impute(days).df.select("event_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


_TYPED = {
    "order_key": "cast(l_orderkey AS string)",
    "quantity": "concat(cast(l_quantity AS bigint), CASE WHEN l_linenumber = 3 THEN '.0' ELSE '' END)",
    "tax": "CASE WHEN l_orderkey % 50 = 0 THEN 'n/a?' ELSE cast(l_tax AS string) END",
    "is_open": "CASE WHEN l_linestatus = 'O' THEN 'yes' ELSE 'NO' END",
    "shipped": "cast(cast(l_shipdate AS date) AS string)",
    "flag": "l_returnflag",
}


@query(
    "apply_schema",
    "SELECT l_orderkey AS order_key, cast(l_quantity AS bigint) AS quantity, "
    "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_tax END AS tax, l_linestatus = 'O' AS is_open, "
    "strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_returnflag AS flag FROM lineitem",
)
def apply_schema(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _TYPED.items()])
    stats = schema.profile_types(df)
    typed = schema.apply_schema(df, schema.detect_schema(df, stats), stats).df
    return typed.withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


_BOUNDS = (
    "SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper, * FROM (SELECT "
    "quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM ({s}))"
)


def _box_sql(c: str, source: str) -> str:
    # DuckDB's least and greatest pass over NULLs.
    clipped = f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, upper), lower) END"
    return (
        f"SELECT '{c}' AS \"column\", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, "
        f"round(lower, 6) AS lower, round(upper, 6) AS upper, count({c}) AS filled, "
        f"round(min({clipped}), 6) AS whisker_low, round(max({clipped}), 6) AS whisker_high, "
        f"count(*) FILTER (WHERE {c} < lower OR {c} > upper) AS outliers "
        f"FROM ({source}), ({_BOUNDS.format(c=c, s=source)}) GROUP BY q1, median, q3, lower, upper"
    )


@query("boxplot_stats", _box_sql("price", LINES.sql) + " UNION ALL " + _box_sql("quantity", LINES.sql))
def boxplot_stats(spark, sf_dir):
    df = outliers.boxplot_stats(LINES.frame(spark, sf_dir), ["price", "quantity"])
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return df.select(*rounded)


@query(
    "clip_outliers",
    "SELECT order_key, line, round(greatest(least(price, upper), lower), 6) AS price FROM "
    f"({LINES.sql}), ({_BOUNDS.format(c='price', s=LINES.sql)})",
)
def clip_outliers(spark, sf_dir):
    df = outliers.clip_outliers(LINES.frame(spark, sf_dir), ["price"])
    return df.select("order_key", "line", F.round("price", 6).alias("price"))


@query(
    "outlier_flags",
    "SELECT event_id, value, coalesce(value < lower OR value > upper, false) AS value_outlier FROM events, "
    f"({_BOUNDS.format(c='value', s='SELECT * FROM events')})",
)
def outlier_flags(spark, sf_dir):
    df = outliers.outlier_flags(table(spark, sf_dir, "events"), ["value"])
    return df.select("event_id", "value", "value_outlier")


@query(
    "quartiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
        f"round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem" for c in ("l_extendedprice", "l_orderkey", "l_tax")
    ),
)
def quartiles(spark, sf_dir):
    """By narrowing intervals, as for tables too large for one task."""
    from sluicebox.operators.quantiles import exact_quantiles

    found = exact_quantiles(
        table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_orderkey", "l_tax"], (0.25, 0.5, 0.75), bound=100
    )
    rows = [(c, *[round(q, 6) for q in qs]) for c, qs in found.items()]
    return spark.createDataFrame(rows, "column string, q25 double, q50 double, q75 double")
