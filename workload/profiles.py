"""What a profile measures, and what is decided from it."""
from pyspark.sql import functions as F

from sluicebox.operators import outliers, profile, schema, standardize
from sluicebox.operators.columns import rename_clean
from sluicebox.operators.validate import edge_blanks, is_structural
from workload.registry import LINES, ORDERS, query, table, union_all

_DIRT = {
    "text_dirty": r"\[[^\]]*\]|[†‡*]|[\x00-\x1F\x7F]",
    "money_dirty": r"[$€£₹(),]|\d+[KMBkmb]$",
    "year": r"(19\d{2}|20\d{2})",
    "year_range": r"(19\d{2}|20\d{2}).*(19\d{2}|20\d{2})",
}


def _share(test: str, base: str) -> str:
    return f"count(*) FILTER (WHERE {test})::DOUBLE / nullif(count({base}), 0)"


def _dirty_sql(source: str, columns) -> str:
    parts = []
    for c in columns:
        shares = ", ".join(f"{_share(f'regexp_matches({c}, $rx${p}$rx$)', c)} AS {n}" for n, p in _DIRT.items())
        parts.append(f"SELECT '{c}' AS \"column\", {shares} FROM ({source})")
    return union_all(parts)


def _dirty(df):
    return profile.measure(df, groups=("dirt", "years")).select(
        "column", *[(F.col(n) / F.col("filled")).alias(n) for n in _DIRT]
    )


@query("dirty_ratios_documents", _dirty_sql("SELECT * FROM documents", ["text", "lang", "source"]))
def dirty_ratios_documents(spark, sf_dir):
    return _dirty(table(spark, sf_dir, "documents").select("text", "lang", "source"))


_ORDER_TEXTS = ["status", "price", "years", "priority"]


@query("dirty_ratios_orders", _dirty_sql(ORDERS.sql, _ORDER_TEXTS))
def dirty_ratios_orders(spark, sf_dir):
    return _dirty(ORDERS.frame(spark, sf_dir).select(*_ORDER_TEXTS))


_ID_TESTS = "regexp_matches({c}, '^[A-Za-z0-9\\-_]{{8,}}$') AND regexp_matches({c}, '[A-Za-z]') AND regexp_matches({c}, '\\d')"


def _id_sql(source, columns):
    parts = []
    for c, is_text in columns.items():
        value = f"coalesce({_share(_ID_TESTS.format(c=c), c)}, 0) >= 0.9" if is_text else "false"
        name = str(c in ("id", "uuid", "guid") or c.endswith("_id")).lower()
        unique = f"count(DISTINCT {c})::DOUBLE / count({c}) >= 0.95"
        parts.append(
            f"SELECT '{c}' AS \"column\", {name} AS by_name, {value} AS by_value, {unique} AS by_uniqueness, "
            f"({name})::INT + ({value})::INT + ({unique})::INT >= 2 AS is_id FROM ({source})"
        )
    return union_all(parts)


_ID_COLUMNS = {"c_name": True, "c_mktsegment": True, "cust_id": False, "account_id": True, "c_nationkey": False}
_ID_SOURCE = (
    "SELECT c_name, c_mktsegment, c_custkey AS cust_id, concat('ACC-', 10000000 + c_custkey) AS account_id, "
    "c_nationkey FROM customer"
)


@query("id_signals", _id_sql(_ID_SOURCE, _ID_COLUMNS))
def id_signals(spark, sf_dir):
    df = table(spark, sf_dir, "customer").selectExpr(
        "c_name", "c_mktsegment", "c_custkey AS cust_id", "concat('ACC-', 10000000 + c_custkey) AS account_id",
        "c_nationkey",
    )
    stats = profile.collect_stats(df, groups=("identity",))
    for name, distinct in profile.distinct_counts(df, list(stats)).items():
        stats[name].distinct = distinct
    out = [
        (c, standardize.name_looks_like_id(c), standardize.value_looks_like_id(s),
         standardize.is_highly_unique(s), standardize.is_id(s))
        for c, s in stats.items()
    ]
    return spark.createDataFrame(
        out, "column string, by_name boolean, by_value boolean, by_uniqueness boolean, is_id boolean"
    )


def _text_sql(source, columns):
    return union_all(
        f"SELECT '{c}' AS \"column\", " + _share(f"regexp_matches({c}, '[A-Za-z]')", c) + " AS letters, "
        + _share(rf"regexp_matches({c}, '^\d+(\.\d+)?$')", c) + " AS plain_number FROM (" + source + ")"
        for c in columns
    )


_CONVERSATION = ["role", "text"]


@query(
    "text_signals",
    union_all([
        _text_sql("SELECT * FROM conversations", _CONVERSATION),
        _text_sql(ORDERS.sql, _ORDER_TEXTS),
        _text_sql(LINES.sql, ["discount_text"]),
    ]),
)
def text_signals(spark, sf_dir):
    frames = [
        table(spark, sf_dir, "conversations").select(*_CONVERSATION),
        ORDERS.frame(spark, sf_dir).select(*_ORDER_TEXTS),
        LINES.frame(spark, sf_dir).select("discount_text"),
    ]
    parts = [
        profile.measure(df, groups=("letters",)).select(
            "column", *[(F.col(n) / F.col("filled")).alias(n) for n in ("letters", "plain_number")]
        )
        for df in frames
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LINE_NUMBERS = ["order_key", "line", "quantity", "price", "tax", "ship_year"]


@query(
    "year_signal",
    union_all(
        f"SELECT '{c}' AS \"column\", {_share(f'{c} BETWEEN 1800 AND 2200', c)} AS in_years, "
        f"{_share(f'{c} BETWEEN 1800 AND 2200', c)} >= 0.8 AS is_structural FROM ({LINES.sql})"
        for c in _LINE_NUMBERS
    ),
)
def year_signal(spark, sf_dir):
    stats = profile.collect_stats(LINES.frame(spark, sf_dir), _LINE_NUMBERS, ("numbers",))
    rows = [(c, s.of_filled("in_years"), is_structural(s)) for c, s in stats.items()]
    return spark.createDataFrame(rows, "column string, in_years double, is_structural boolean")


_DATE_CELLS = {
    "iso": "cast(cast(o_orderdate AS date) AS string)",
    "slashes": "concat(day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate))",
    "mixed": "CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE cast(cast(o_orderdate AS date) AS string) END",
    "never": "o_orderstatus",
}


@query(
    "date_signal",
    "SELECT 'iso' AS \"column\", 'iso_date' AS format, 1.0::DOUBLE AS fits FROM orders GROUP BY 1, 2 UNION ALL "
    "SELECT 'slashes', 'slash_dmy', count(o_orderdate)::DOUBLE / count(*) FROM orders UNION ALL "
    "SELECT 'mixed', 'iso_date', count(*) FILTER (WHERE o_orderkey % 3 <> 0)::DOUBLE / count(*) FROM orders UNION ALL "
    "SELECT 'never', NULL, 0.0 FROM orders GROUP BY 1, 2",
)
def date_signal(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _DATE_CELLS.items()])
    rows = []
    for name, s in profile.collect_stats(df, groups=("dates",)).items():
        date_format, fits = s.best_date_format()
        rows.append((name, date_format, fits / s.filled))
    return spark.createDataFrame(rows, "column string, format string, fits double")


@query(
    "numeric_like",
    f"SELECT 'discount_text' AS \"column\", count(TRY_CAST(discount_text AS DOUBLE))::DOUBLE / count(*) AS numeric_ratio "
    f"FROM ({LINES.sql}) UNION ALL SELECT 'flag', count(TRY_CAST(flag AS DOUBLE))::DOUBLE / count(*) FROM ({LINES.sql})",
)
def numeric_like(spark, sf_dir):
    df = LINES.frame(spark, sf_dir).select("discount_text", "flag")
    return profile.measure(df, groups=("numbers",)).select(
        "column", (F.col("parsed") / F.col("rows")).alias("numeric_ratio")
    )


def _type_sql(source: str, columns: dict[str, str]) -> str:
    parts = []
    for c, kind in columns.items():
        parsed = f"count(TRY_CAST({c} AS DOUBLE))" if kind != "time" else "0"
        number = f"TRY_CAST({c} AS DOUBLE)"
        whole = f"count(*) FILTER (WHERE {number} = floor({number}))" if kind != "time" else "0"
        date = f"TRY_CAST({c} AS DATE)" if kind == "text" else "NULL"
        if kind == "time":
            logical = f"CASE WHEN count({c}) = 0 THEN 'text' ELSE 'datetime' END"
        else:
            logical = (
                f"CASE WHEN count({c}) = 0 THEN 'text' "
                f"WHEN count(*) FILTER (WHERE lower({c}::VARCHAR) IN ('0', '1', 'true', 'false', 'yes', 'no')) = count({c}) THEN 'boolean' "
                f"WHEN {parsed} >= 0.95 * count({c}) THEN CASE WHEN {whole} >= 0.99 * {parsed} THEN 'integer' ELSE 'float' END "
                f"WHEN count({date}) >= 0.95 * count({c}) THEN 'datetime' "
                f"WHEN count(DISTINCT {c}) <= 0.1 * count({c}) THEN 'category' ELSE 'text' END"
            )
        parts.append(f"SELECT '{c}' AS \"column\", {logical} AS logical_type FROM ({source})")
    return union_all(parts)


def _types(spark, df):
    return spark.createDataFrame(list(schema.detect_schema(df).items()), "column string, logical_type string")


_PART_COLUMNS = {"p_partkey": "n", "p_name": "text", "p_brand": "text", "p_type": "text", "p_size": "n", "p_retailprice": "n"}


@query("detect_schema_part", _type_sql("SELECT * FROM part", _PART_COLUMNS))
def detect_schema_part(spark, sf_dir):
    return _types(spark, table(spark, sf_dir, "part"))


_EVENT_COLUMNS = {"event_id": "n", "ts": "time", "user_id": "n", "event_type": "text", "value": "n", "props": "text"}


@query("detect_schema_events", _type_sql("SELECT * FROM events", _EVENT_COLUMNS))
def detect_schema_events(spark, sf_dir):
    return _types(spark, table(spark, sf_dir, "events"))


_MIXED = (
    "doc_id", "text", "lang", "source", "n_chars", "cast(doc_id % 2 AS string) AS bit",
    "CASE WHEN doc_id % 2 = 0 THEN 'Yes' ELSE 'no' END AS answer",
    "concat(n_chars, CASE WHEN doc_id % 2 = 0 THEN '.5' ELSE '' END) AS half",
    "concat('2024-', 10 + doc_id % 3, '-', 10 + doc_id % 20) AS day", "CAST(NULL AS string) AS nothing",
)
_MIXED_COLUMNS = {
    "doc_id": "n", "text": "text", "lang": "text", "source": "text", "n_chars": "n", "bit": "text",
    "answer": "text", "half": "text", "day": "text", "nothing": "text",
}


@query("detect_schema_documents", _type_sql(f"SELECT {', '.join(_MIXED)} FROM documents", _MIXED_COLUMNS))
def detect_schema_documents(spark, sf_dir):
    return _types(spark, table(spark, sf_dir, "documents").selectExpr(*_MIXED))


def _route_sql(source: str, columns) -> str:
    parts = []
    for c in columns:
        txt = f"cast({c} AS string)"

        def share(pattern: str) -> str:
            return f"coalesce({_share(f'regexp_matches({txt}, $rx${pattern}$rx$)', c)}, 0)"

        parts.append(
            f"SELECT '{c}' AS \"column\", CASE WHEN {share(_DIRT['year_range'])} >= 0.6 THEN 'year' "
            f"WHEN {share(_DIRT['money_dirty'])} >= 0.1 THEN 'numeric' "
            f"WHEN {share('[A-Za-z]')} >= 0.6 AND {share(r'^[0-9]+([.][0-9]+)?$')} < 0.2 "
            f"THEN CASE WHEN {share(_DIRT['text_dirty'])} >= 0.6 THEN 'text' ELSE 'strip' END "
            f"ELSE 'keep' END AS route FROM ({source})"
        )
    return union_all(parts)


@query("route_columns", _route_sql(ORDERS.sql, ORDERS.columns))
def route_columns(spark, sf_dir):
    """Blank-edged priorities end in a tab, a control character, so they count as dirty text."""
    routes, _ = standardize.profile_routes(ORDERS.frame(spark, sf_dir))
    return spark.createDataFrame(list(routes.items()), "column string, route string")


_NUMERIC_LINES = ["order_key", "line", "quantity", "price", "tax"]


@query(
    "outlier_columns",
    union_all(
        f"SELECT 'by_values' AS mode, '{c}' AS \"column\" FROM ({LINES.sql}) HAVING min({c}) <> max({c})"
        for c in _NUMERIC_LINES
    ) + " UNION ALL " + union_all(
        f"SELECT 'by_values', '{c}' FROM ({LINES.sql}) HAVING count(TRY_CAST({c} AS DOUBLE)) >= 0.6 * count(*)"
        for c in ("flag", "discount_text", "remark")
    ) + " UNION ALL " + union_all(
        f"SELECT 'by_schema', '{c}' FROM ({LINES.sql}) HAVING count(TRY_CAST({c} AS DOUBLE)) >= 0.95 * count({c}) "
        f"AND count({c}) > 0 AND count(*) FILTER (WHERE lower({c}::VARCHAR) IN ('0', '1', 'true', 'false', 'yes', 'no')) < count({c})"
        for c in [*_NUMERIC_LINES, "flag", "discount_text", "remark"]
    ),
)
def outlier_columns(spark, sf_dir):
    df = LINES.frame(spark, sf_dir)
    rows = [("by_values", c) for c in outliers.eligible_by_values(df)]
    rows += [("by_schema", c) for c in outliers.eligible_by_schema(df, schema.detect_schema(df))]
    return spark.createDataFrame(rows, "mode string, column string")


@query(
    "distinct_values",
    union_all(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM lineitem"
        for c in ("l_orderkey", "l_extendedprice", "l_returnflag", "l_shipdate")
    ) + " UNION ALL SELECT 'text', count(DISTINCT text) FROM documents",
)
def distinct_values(spark, sf_dir):
    lines = profile.distinct_frame(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_extendedprice", "l_returnflag", "l_shipdate"]
    )
    return lines.unionByName(profile.distinct_frame(table(spark, sf_dir, "documents"), ["text"]))


@query(
    "edge_blanks",
    union_all(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE starts_with({c}, ' ') OR ends_with({c}, ' ')) AS edge_blank "
        f"FROM ({ORDERS.sql})"
        for c in [*_ORDER_TEXTS, "comment"]
    ),
)
def edge_blank_counts(spark, sf_dir):
    return edge_blanks(ORDERS.frame(spark, sf_dir))


@query(
    "clean_column_names",
    "SELECT event_id AS event_id, strftime(ts, '%Y-%m-%d') AS time_stamp_utc, user_id AS user, event_type AS user_2, "
    "value AS unnamed_4, props AS p_r_o_p_s FROM events",
)
def clean_column_names(spark, sf_dir):
    """Blank, repeated and punctuated names."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd"))
    return rename_clean(events.toDF(" Event  ID ", "Time-Stamp (UTC)", "User", "USER!", "?", "__p.r..o p-s__"))
