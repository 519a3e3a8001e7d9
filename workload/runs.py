"""Whole runs on dirtied tables: load, clean, transform, write, read back."""
import tempfile
import uuid

from pyspark.sql import functions as F

from sluicebox.operators.profile import ROW_ORDER
from sluicebox.operators.validate import check_written
from sluicebox.operators.schema import apply_schema, detect_schema, profile_types
from sluicebox.plans.clean import clean_csv, clean_frame
from sluicebox.plans.overview import overview
from sluicebox.plans.transform import save_plan, transform_to_table
from sluicebox.plans.workspace import Workspace, shared_folder
from sluicebox.sources import csv, tables
from sluicebox.sources.artifacts import Artifacts
from workload.registry import CSV_MISSING_SQL, ORDERS, Dirt, query, sql_mode, table, union_all

MESSY_LINES = Dirt("lineitem", {
    "Line Ref.": "concat(l_orderkey, '/', l_linenumber)",
    "Quantity": "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END",
    "Price (USD)": (
        "CASE l_linenumber % 3 WHEN 0 THEN concat('$', cast(floor(l_extendedprice) AS bigint)) "
        "WHEN 1 THEN concat('$', cast(floor(l_extendedprice / 1000) AS bigint), 'K') "
        "ELSE concat('$', cast(floor(l_extendedprice) AS bigint), '[a]') END"
    ),
    "Return Flag": (
        "CASE l_orderkey % 11 WHEN 0 THEN '-' WHEN 1 THEN 'nan' WHEN 2 THEN '<NA>' ELSE concat(l_returnflag, '†') END"
    ),
    "Tax Rate": "l_tax",
    "Ship Years": (
        "CASE WHEN l_orderkey % 4 = 0 THEN concat(year(l_shipdate), '') "
        "ELSE concat(year(l_shipdate), '–', year(l_shipdate) + 1) END"
    ),
    "Shipped": "cast(cast(l_shipdate AS date) AS string)",
    "Discount Note": "concat('disc ', cast(round(l_discount * 100) AS bigint), ' pct †[note]')",
    "Still Open": "CASE WHEN l_linestatus = 'O' THEN 'yes' ELSE 'no' END",
    "Comment": "CAST(NULL AS string)",
})

# What loading, standardising and imputing must make of it, column by column.
_FLAG = (
    f"CASE WHEN \"Return Flag\" IN ({CSV_MISSING_SQL}, '-') THEN NULL ELSE left(\"Return Flag\", 1) END"
)
_AMOUNT = (
    "cast(CASE WHEN \"Price (USD)\" LIKE '%K' THEN cast(substr(\"Price (USD)\", 2, length(\"Price (USD)\") - 2) AS bigint) * 1000 "
    "ELSE cast(regexp_extract(\"Price (USD)\", '[0-9]+') AS bigint) END AS bigint)"
)
_CLEAN_LINES = (
    "SELECT \"Line Ref.\" AS line_ref, cast(coalesce(\"Quantity\", " + sql_mode('"Quantity"', MESSY_LINES.sql) +
    ") AS bigint) AS quantity, " + _AMOUNT + " AS price_usd, coalesce(" + _FLAG + ", " + sql_mode(_FLAG, MESSY_LINES.sql) +
    ") AS return_flag, \"Tax Rate\" AS tax_rate, cast(left(\"Ship Years\", 4) AS bigint) AS ship_years, "
    "\"Shipped\" AS shipped, regexp_replace(\"Discount Note\", ' †.*$', '') AS discount_note, "
    "\"Still Open\" = 'yes' AS still_open, CASE WHEN length(\"Ship Years\") > 4 THEN cast(right(\"Ship Years\", 4) AS bigint) END AS ship_years_end "
    f"FROM ({MESSY_LINES.sql})"
)
_UNIQUE_LINES = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY line_ref, ship_years, ship_years_end ORDER BY "
    "line_ref, quantity, price_usd, return_flag, tax_rate, ship_years, shipped, discount_note, still_open, ship_years_end) AS rn "
    f"FROM ({_CLEAN_LINES})) WHERE rn = 1"
)


@query("full_clean_lineitem", _UNIQUE_LINES)
def full_clean_lineitem(spark, sf_dir):
    """Ten messy columns to clean ones; the keys found are the line reference and the years."""
    run = clean_frame(MESSY_LINES.frame(spark, sf_dir), "lineitem")
    return run.df.withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


MESSY_ORDERS = Dirt("orders", {
    " Order ID ": "o_orderkey",
    "Status": ORDERS.columns["status"],
    "Total": "concat('$', cast(floor(o_totalprice) AS bigint), CASE WHEN o_orderkey % 3 = 0 THEN ' [c]' ELSE '' END)",
    "Priority": ORDERS.columns["priority"],
    "Customer": "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END",
    "Ordered in Year": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE cast(year(o_orderdate) AS int) END",
    "Note": "CAST(NULL AS string)",
})
_ORDER_STATUS = "CASE WHEN \"Status\" IN ('-', 'nan', '<NA>', '  ') THEN NULL ELSE \"Status\" END"


_CLEAN_ORDERS = (
    "SELECT \" Order ID \" AS order_id, coalesce(" + _ORDER_STATUS + ", " + sql_mode(_ORDER_STATUS, MESSY_ORDERS.sql) +
    ") AS status, cast(regexp_extract(\"Total\", '[0-9]+') AS bigint) AS total, "
    r"""regexp_replace("Priority", '^\s+|\s+$', '', 'g') AS priority, coalesce("Customer", """ + sql_mode('"Customer"', MESSY_ORDERS.sql) +
    f") AS customer, cast(\"Ordered in Year\" AS bigint) AS ordered_in_year FROM ({MESSY_ORDERS.sql})"
)


@query("full_clean_orders", _CLEAN_ORDERS)
def full_clean_orders(spark, sf_dir):
    """An id column, so nothing repeats; year gaps stay."""
    return clean_frame(MESSY_ORDERS.frame(spark, sf_dir), "orders").df


@query("full_clean_csv", _CLEAN_ORDERS)
def full_clean_csv(spark, sf_dir):
    """The same table, read as CSV."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    tables.write_csv(MESSY_ORDERS.frame(spark, sf_dir), path)
    return clean_csv(spark, path).df.drop(ROW_ORDER)


@query(
    "full_clean_checks",
    union_all([
        "SELECT 'orders' AS dataset, 'non_empty' AS \"check\", 'PASS' AS status, count(*)::DOUBLE AS metric FROM orders",
        "SELECT 'orders', 'schema_match', 'PASS', 0 FROM orders GROUP BY 1",
        "SELECT 'orders', 'deduplication', 'PASS', (count(*) - count(DISTINCT o_orderkey))::DOUBLE FROM orders",
        "SELECT 'orders', 'no_nulls', 'PASS', count(*) FILTER (WHERE o_orderkey % 6 = 0)::DOUBLE FROM orders",
        "SELECT 'orders', 'row_drop_ratio', 'PASS', 0 FROM orders GROUP BY 1",
    ]),
)
def full_clean_checks(spark, sf_dir):
    run = clean_frame(MESSY_ORDERS.frame(spark, sf_dir), "orders")
    return run.validation.as_frame(spark).select("dataset", "check", "status", "metric")


@query(
    "csv_round_trip",
    "SELECT event_id, user_id, event_type, CAST(ts AS VARCHAR) AS ts, value, props FROM events",
)
def csv_round_trip(spark, sf_dir):
    """Written as CSV and read again with types found from the values."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    tables.write_csv(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string")), path)
    return tables.read_cleaned(spark, path)


@query(
    "load_csv",
    "SELECT o_orderkey AS order_id, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE cast(o_custkey AS DOUBLE) END AS customer, "
    "regexp_replace(o_orderpriority, '^\\s+|\\s+$', '', 'g') AS priority, o_totalprice AS total_usd, o_orderstatus = 'O' AS open, "
    "concat('say \"', o_orderstatus, '\", ok') AS quoted, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day FROM orders",
)
def load_csv(spark, sf_dir):
    """Messy header and cells: notes, tabs, quotes, gaps; a whole column with gaps becomes double."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS `Order ID`", "CASE WHEN o_custkey % 7 = 0 THEN 'N/A' ELSE cast(o_custkey AS string) END AS ` Customer `",
        "concat('  ', o_orderpriority, ' [x]†') AS Priority", "o_totalprice AS `Total (USD)`",
        "CASE WHEN o_orderstatus = 'O' THEN 'True' ELSE 'False' END AS `Open?`",
        "concat('say \"', o_orderstatus, '\", ok') AS Quoted", "cast(cast(o_orderdate AS date) AS string) AS Day",
    )
    tables.write_csv(raw, path)
    return csv.read_csv(spark, path).drop(ROW_ORDER)


@query(
    "table_round_trip",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def table_round_trip(spark, sf_dir):
    """Written to the catalog, found by a part of its name, checked and read back."""
    part = table(spark, sf_dir, "part")
    name = tables.write_table(part, f"part_{uuid.uuid4().hex[:8]}_20260101_120000")
    check_written(spark, name, expected_rows=part.count())
    database, found = tables.find_table(spark, name.split("`")[3].upper())
    return tables.read_table(spark, database, found)


@query(
    "written_checks",
    "SELECT c AS \"column\", 0::BIGINT AS nulls, n AS rows FROM (SELECT count(*) AS n FROM customer), "
    "(SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS c)",
)
def written_checks(spark, sf_dir):
    """NULLs and rows counted in the stored table."""
    customer = table(spark, sf_dir, "customer")
    name = tables.write_table(customer, f"customer_{uuid.uuid4().hex[:8]}")
    nulls, rows = check_written(spark, name, customer.count())
    return spark.createDataFrame([(c, n, rows) for c, n in nulls.items()], "column string, nulls bigint, rows bigint")


@query("staged_table", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def staged_table(spark, sf_dir):
    """A written table between two passes, in the shared folder."""
    return Workspace(spark).stage(table(spark, sf_dir, "documents"), "documents")


@query(
    "text_export",
    "SELECT concat_ws('|', c_custkey, c_name, c_nationkey, CAST(round(c_acctbal * 100) AS BIGINT), c_mktsegment) AS value FROM customer",
)
def text_export(spark, sf_dir):
    path = f"{shared_folder(spark)}/text-{uuid.uuid4().hex}"
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    tables.write_text(table(spark, sf_dir, "customer").withColumn("c_acctbal", cents), path, "|")
    return spark.read.text(path)


@query(
    "full_transform_part",
    "SELECT cast(p_partkey AS DOUBLE) AS p_partkey, p_name, p_brand, p_type, cast(p_size AS DOUBLE) AS p_size, "
    "p_retailprice, regexp_replace(regexp_replace(lower(concat(p_brand, ';', p_type, ' / ', p_name)), '[;:/]', ',', 'g'), "
    r"'\s*,\s*', ',', 'g') AS tags FROM (SELECT p_partkey, lower(p_name) AS p_name, lower(p_brand) AS p_brand, "
    "lower(p_type) AS p_type, p_size, p_retailprice FROM part)",
)
def full_transform_part(spark, sf_dir):
    """A plan suggested, saved, applied, written to a table and checked there."""
    df = table(spark, sf_dir, "part").withColumn("tags", F.expr("concat(p_brand, ';', p_type, ' / ', p_name)"))
    dataset = f"part_{uuid.uuid4().hex[:8]}"
    artifacts = Artifacts(tempfile.mkdtemp(prefix="sluicebox-"))
    save_plan(df, dataset, artifacts)
    return spark.table(transform_to_table(spark, df, dataset, artifacts).table)


@query(
    "stored_overview",
    "SELECT count(*) AS rows, cast(6 AS bigint) AS columns, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS missing, "
    "'year_made_end' AS structural FROM orders",
)
def stored_overview(spark, sf_dir):
    """Found in the catalog by a part of its name, with its headline numbers."""
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "year(o_orderdate) AS year_made",
        "CASE WHEN o_orderkey % 4 <> 0 THEN year(o_orderdate) + 1 END AS year_made_end",
    )
    dataset = f"orders_{uuid.uuid4().hex[:8]}"
    tables.write_table(df, dataset)
    found = overview(spark, dataset.upper())
    return found.headline.withColumn("structural", F.lit(",".join(found.structural_gaps)))


@query("boolean_labels", "SELECT doc_id, quality = 1 AS quality, toxic = 1 AS toxic FROM labels")
def boolean_labels(spark, sf_dir):
    """Columns of 0 and 1 become truth values."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    stats = profile_types(labels)
    return apply_schema(labels, detect_schema(labels, stats), stats).df
