"""Cell rules applied to whole columns."""
from pyspark.sql import functions as F

from sluicebox.functions import parsing, text
from sluicebox.operators.missing import normalize_missing
from workload.registry import (
    ORDERS, PARTS, query, sql_amount, sql_clean_text, sql_null_missing, sql_years, table,
)


@query("clean_text_documents", f"SELECT doc_id, {sql_clean_text('text')} AS clean FROM documents")
def clean_text_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("clean"))


@query("clean_text_pages", f"SELECT page_id, {sql_clean_text('html')} AS clean FROM pages")
def clean_text_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean_text(F.col("html")).alias("clean"))


@query(
    "clean_text_conversations",
    f"SELECT conv_id, turn, role, {sql_clean_text('text')} AS clean FROM conversations",
)
def clean_text_conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", text.clean_text(F.col("text")).alias("clean")
    )


_MENDED = "replace(replace(replace(label, 'â€¡', ''), 'ﬁ', 'fi'), '［x］', '[x]')"


@query("clean_text_footnotes", f"SELECT part_key, {sql_clean_text(_MENDED)} AS clean FROM ({PARTS.sql})")
def clean_text_footnotes(spark, sf_dir):
    """Broken encodings, ligatures and full-width brackets as well as notes."""
    cleaned = text.clean_text(text.fix_mojibake(F.col("label")))
    return PARTS.frame(spark, sf_dir).select("part_key", cleaned.alias("clean"))


@query(
    "normalize_missing",
    f"SELECT order_key, {sql_null_missing('status')} AS status, customer FROM ({ORDERS.sql})",
)
def missing_words(spark, sf_dir):
    return normalize_missing(ORDERS.frame(spark, sf_dir).select("order_key", "status", "customer"))


@query(
    "clean_numeric_amounts",
    f"SELECT order_key, {sql_amount('price')} AS amount, "
    f"{sql_amount('price')} IS NULL AS kept_as_text FROM ({ORDERS.sql})",
)
def clean_numeric_amounts(spark, sf_dir):
    amount = parsing.clean_numeric(F.col("price"))
    return ORDERS.frame(spark, sf_dir).select(
        "order_key", amount.alias("amount"), amount.isNull().alias("kept_as_text")
    )


@query(
    "clean_numeric_or_keep",
    f"SELECT order_key, CASE WHEN {sql_amount('price')} IS NULL THEN price ELSE "
    f"concat(cast({sql_amount('price')} AS bigint), '.0') END AS price FROM ({ORDERS.sql})",
)
def clean_numeric_or_keep(spark, sf_dir):
    return ORDERS.frame(spark, sf_dir).select(
        "order_key", parsing.clean_numeric_or_keep(F.col("price")).alias("price")
    )


_YEARS = sql_years("replace(years, '–', '-')")


@query(
    "extract_year_range",
    f"SELECT order_key, cast({_YEARS}[1] AS bigint) AS years, "
    f"CASE WHEN len({_YEARS}) > 1 THEN cast({_YEARS}[-1] AS bigint) END AS years_end FROM ({ORDERS.sql})",
)
def extract_year_range(spark, sf_dir):
    first, last = parsing.year_bounds(F.col("years"))
    return ORDERS.frame(spark, sf_dir).select("order_key", first.alias("years"), last.alias("years_end"))


@query("strip_blanks", rf"SELECT order_key, regexp_replace(priority, '^\s+|\s+$', '', 'g') AS priority FROM ({ORDERS.sql})")
def strip_blanks(spark, sf_dir):
    return ORDERS.frame(spark, sf_dir).select("order_key", text.strip(F.col("priority")).alias("priority"))


_NUMBER_CELL = (
    "CASE event_id % 6 WHEN 0 THEN concat(' ', user_id, ' ') WHEN 1 THEN concat('-', user_id, 'e2') "
    "WHEN 2 THEN concat(user_id, 'd') WHEN 3 THEN concat('.', 1 + user_id) WHEN 4 THEN 'inf' ELSE event_type END"
)


@query(
    "parse_number",
    f"SELECT event_id, CASE WHEN event_id % 6 = 4 THEN 'Infinity'::DOUBLE "
    f"ELSE TRY_CAST({_NUMBER_CELL} AS DOUBLE) END AS number FROM events",
)
def parse_number(spark, sf_dir):
    cells = table(spark, sf_dir, "events").selectExpr("event_id", f"{_NUMBER_CELL} AS cell")
    return cells.select("event_id", parsing.parse_number(F.col("cell")).alias("number"))


_DATE_CELL = (
    "CASE WHEN o_orderkey % 9 = 0 THEN concat(day(o_orderdate), '/', month(o_orderdate)) "
    "ELSE concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate)) END"
)


@query(
    "parse_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL "
    "ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date FROM orders",
)
def parse_date(spark, sf_dir):
    cells = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_DATE_CELL} AS cell")
    parsed = parsing.parse_date(F.col("cell"), "slash_mdy")
    return cells.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("order_date"))


@query(
    "parse_boolean",
    f"SELECT event_id, event_id % 3 <> 2 AND user_id % 2 = 1 AS flag FROM events",
)
def parse_boolean(spark, sf_dir):
    cell = (
        "CASE event_id % 3 WHEN 0 THEN CASE WHEN user_id % 2 = 1 THEN 'Yes' ELSE 'NO' END "
        "WHEN 1 THEN concat(user_id % 2, '') ELSE 'false' END"
    )
    cells = table(spark, sf_dir, "events").selectExpr("event_id", f"{cell} AS cell")
    return cells.select("event_id", parsing.parse_boolean(F.col("cell")).alias("flag"))


@query("lowercase_text", "SELECT doc_id, lower(text) AS text FROM documents")
def lowercase_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))


@query(
    "normalize_delimiters",
    rf"SELECT part_key, regexp_replace(regexp_replace(tags, '[;:/]', ',', 'g'), '\s*,\s*', ',', 'g') AS tags "
    f"FROM ({PARTS.sql})",
)
def normalize_delimiters(spark, sf_dir):
    return PARTS.frame(spark, sf_dir).select("part_key", text.normalize_delimiters(F.col("tags")).alias("tags"))


@query("split_multi_values", f"SELECT part_key, replace(trim(lower(tags)), ';', ',') AS tags FROM ({PARTS.sql})")
def split_multi_values(spark, sf_dir):
    return PARTS.frame(spark, sf_dir).select("part_key", text.split_multi_values(F.col("tags")).alias("tags"))


@query(
    "split_year",
    "SELECT part_key, cast(1950 + size AS bigint) AS years_made_start, "
    f"CASE WHEN size % 3 <> 0 THEN cast(1951 + size AS bigint) END AS years_made_end FROM ({PARTS.sql})",
)
def split_year(spark, sf_dir):
    start, end = parsing.split_year(F.col("years_made"))
    return PARTS.frame(spark, sf_dir).select(
        "part_key", start.alias("years_made_start"), end.alias("years_made_end")
    )
