"""Runs that must keep every digit, character, row and gap."""
import uuid

from pyspark.sql import functions as F

from sluicebox.functions.parsing import parse_date
from sluicebox.operators.profile import ROW_ORDER
from sluicebox.plans.batch import clean_directory
from sluicebox.plans.clean import clean_csv, clean_frame
from sluicebox.plans.transform import apply_saved_plan, save_plan, transform_to_table
from sluicebox.plans.workspace import shared_folder
from sluicebox.sources import csv, tables
from sluicebox.sources.artifacts import Artifacts
from workload.registry import Dirt, query, table
from workload.runs import MESSY_ORDERS


def _folder(spark, what):
    """A new folder in the shared one, as a URI."""
    folder = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    return folder if "://" in folder else f"file://{folder}"


BIG_IDS = Dirt("orders", {
    "order_id": "1200000000000000000 + 250 * o_orderkey + o_orderkey % 7",
    "code": "concat('', 9007199254740993 + 2 * o_orderkey)",
    "status": "o_orderstatus",
    "total": "o_totalprice",
})
_BIG = (
    "SELECT 1200000000000000000 + 250 * o_orderkey + o_orderkey % 7 AS order_id, 9007199254740993 + 2 * o_orderkey AS code, "
    "o_orderstatus AS status, o_totalprice AS total, 0::BIGINT AS removed FROM orders"
)


@query("full_clean_big_ids", _BIG)
def full_clean_big_ids(spark, sf_dir):
    """Unique ids beyond what a double holds: no row goes, no digit changes."""
    run = clean_frame(BIG_IDS.frame(spark, sf_dir), "orders")
    return run.df.withColumn("removed", F.lit(run.dedup.removed).cast("bigint"))


@query("full_clean_big_ids_csv", _BIG)
def full_clean_big_ids_csv(spark, sf_dir):
    """The same from CSV."""
    path = tables.write_csv(BIG_IDS.frame(spark, sf_dir), _folder(spark, "csv"))
    run = clean_csv(spark, path, multi_line=False)
    return run.df.drop(ROW_ORDER).withColumn("removed", F.lit(run.dedup.removed).cast("bigint"))


@query(
    "load_big_ids_with_gaps",
    "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 > 0 THEN 1200000000000000000 + 250 * o_orderkey END AS ref FROM orders",
)
def load_big_ids_with_gaps(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "CASE WHEN o_orderkey % 5 > 0 THEN 1200000000000000000 + 250 * o_orderkey END AS ref")
    return csv.read_csv(spark, tables.write_csv(raw, _folder(spark, "csv"))).drop(ROW_ORDER)


@query(
    "big_decimals",
    "SELECT o_orderkey AS k, CAST(o_orderkey AS DECIMAL(30, 2)) * 1000000000000000000 + 0.25 AS amount FROM orders",
)
def big_decimals(spark, sf_dir):
    """Decimals keep their type and digits through types and duplicates."""
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "CAST(CAST(o_orderkey AS DECIMAL(30, 2)) * 1000000000000000000 + 0.25 AS DECIMAL(38, 2)) AS amount")
    return clean_frame(raw, "amounts").df


@query("csv_round_trip_whole", """
    SELECT event_id, user_id, event_type, CAST(ts AS VARCHAR) AS ts, value, props,
      '  ' || event_type || chr(10) || 'line "two", ' || event_id || '  ' AS note FROM events""")
def csv_round_trip_whole(spark, sf_dir):
    """All columns, with line breaks, quotes and blanks at the edges of cells."""
    note = F.concat(F.lit("  "), "event_type", F.lit('\nline "two", '), F.col("event_id").cast("string"), F.lit("  "))
    kept = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string")).withColumn("note", note)
    return tables.read_cleaned(spark, tables.write_csv(kept, _folder(spark, "csv")))


@query("load_csv_multiline", "SELECT doc_id, lang, source, n_chars, text FROM documents")
def load_csv_multiline(spark, sf_dir):
    """Whole texts, line breaks and all, through CSV."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    return csv.read_csv(spark, tables.write_csv(docs, _folder(spark, "csv")), clean=False, missing_words=("",)).drop(ROW_ORDER)


@query(
    "load_csv_latin1",
    "SELECT c_custkey AS k, chr(233) || c_name || chr(252) AS name FROM customer",
)
def load_csv_latin1(spark, sf_dir):
    """Bytes that are not valid UTF-8 are read as Latin-1."""
    path = _folder(spark, "csv")
    raw = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "concat('é', c_name, 'ü') AS name")
    raw.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return csv.read_csv(spark, path, clean=False).drop(ROW_ORDER)


@query(
    "load_csv_mixed_encodings",
    "SELECT c_custkey AS k, 'é' || chr(10) || c_name || 'ü' AS name, c_acctbal AS balance FROM customer",
)
def load_csv_mixed_encodings(spark, sf_dir):
    """One folder with files in UTF-8 and in Latin-1, cells over several lines in both: each file goes by its own bytes."""
    path = _folder(spark, "csv")
    raw = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "concat('é', chr(10), c_name, 'ü') AS name", "c_acctbal AS balance")
    for encoding, part in (("UTF-8", "k % 2 = 0"), ("ISO-8859-1", "k % 2 = 1")):
        raw.where(part).write.mode("append").option("header", True).option("escape", '"').option("encoding", encoding).csv(path)
    return csv.read_csv(spark, path, clean=False).drop(ROW_ORDER)


_PADDED = "concat('                         ', cast(cast(o_orderdate AS date) AS string), '                              ')"


@query("parse_date_padded", "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day FROM orders")
def parse_date_padded(spark, sf_dir):
    """Any amount of blanks around a date."""
    padded = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_PADDED} AS d")
    return padded.select("o_orderkey", F.date_format(parse_date(F.col("d"), "iso_date"), "yyyy-MM-dd").alias("day"))


@query(
    "clean_then_write_orders",
    "SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey % 6 = 0) AS year_gaps FROM orders",
)
def clean_then_write_orders(spark, sf_dir):
    """Cleaned, validated, transformed and stored: the gaps that validation allows stay in the table."""
    run = clean_frame(MESSY_ORDERS.frame(spark, sf_dir), f"orders_{uuid.uuid4().hex[:8]}")
    assert run.validation.status == "PASS"
    artifacts = Artifacts(_folder(spark, "json"))
    save_plan(run.df, run.dataset, artifacts)
    written = transform_to_table(spark, run.df, run.dataset, artifacts, expected_rows=run.shape[0])
    run.workspace.close()
    return spark.table(written.table).agg(
        F.count("*").alias("rows"), F.count_if(F.col("ordered_in_year").isNull()).alias("year_gaps"))


_BOXES = " UNION ALL ".join(
    f"SELECT '{step}' AS step, '{name}' AS \"column\", quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, "
    f"quantile_cont({value}, 0.75) AS q3 FROM lineitem"
    for step in ("before", "after") for name, value in (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("tax", "l_tax"))
)


@query("full_clean_outliers", _BOXES)
def full_clean_outliers(spark, sf_dir):
    """Both box plots of a whole run."""
    raw = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('L', l_orderkey, '-', l_linenumber) AS line_id", "l_quantity AS quantity", "l_extendedprice AS price", "l_tax AS tax")
    run = clean_frame(raw, "lineitem")
    parts = [df.select(F.lit(step).alias("step"), "column", "q1", "median", "q3")
             for step, df in (("before", run.outliers_before), ("after", run.outliers_after))]
    return parts[0].unionByName(parts[1]).where(F.col("column").isin("quantity", "price", "tax"))


@query(
    "batch_artifacts",
    "SELECT 'nation' AS dataset, 'n_nationkey,n_name,n_regionkey' AS columns, 'PASS' AS validation, 'nation' AS plan, true AS report UNION ALL "
    "SELECT 'region', 'r_regionkey,r_name', 'PASS', 'region', true",
)
def batch_artifacts(spark, sf_dir):
    """Every CSV file of a shared folder cleaned; schema, validation, plan and execution report read back from there."""
    folder = _folder(spark, "batch")
    for name, columns in (("region", ["r_regionkey", "r_name"]), ("nation", ["n_nationkey", "n_name", "n_regionkey"])):
        tables.write_csv(table(spark, sf_dir, name).select(*columns).coalesce(1), f"{folder}/in/{name}.csv")
    artifacts, rows = Artifacts(f"{folder}/json"), []
    for run in clean_directory(spark, f"{folder}/in", f"{folder}/out", artifacts):
        save_plan(run.df, run.dataset, artifacts, enable_all=True)
        apply_saved_plan(run.df, run.dataset, artifacts)
        saved = {sort: artifacts.load(run.dataset, sort) for sort in (
            artifacts.SCHEMA, artifacts.VALIDATION, artifacts.PLAN, artifacts.EXECUTION)}
        rows.append((run.dataset, ",".join(saved[artifacts.SCHEMA]), saved[artifacts.VALIDATION]["status"],
                     saved[artifacts.PLAN].get("dataset", run.dataset), saved[artifacts.EXECUTION] is not None))
    return spark.createDataFrame(rows, "dataset string, columns string, validation string, plan string, report boolean")
