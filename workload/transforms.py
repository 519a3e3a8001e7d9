"""Transform plans: suggested, applied, and their table-wide operations."""
import json
import uuid

from pyspark.sql import functions as F

from sluicebox.operators import report, transform
from sluicebox.sources import tables
from workload.registry import LINES, PARTS, query, table, union_all

_DELIMITER = "regexp_matches({c}, '[;/,:]')"


def _plan_sql(source: str, texts, numbers) -> str:
    parts = []
    for c in texts:
        base = f"SELECT '{c}' AS \"column\", '{{step}}' AS step, {{on}} AS enabled FROM ({source})"
        delimited = f" HAVING bool_or({_DELIMITER.format(c=c)})"
        parts += [
            base.format(step="lowercase", on="true") + " HAVING count(*) > 0",
            base.format(step="strip", on="true") + " HAVING count(*) > 0",
            base.format(step="normalize_delimiters", on="true") + delimited,
            base.format(step="split_multi_values", on="false") + delimited,
        ]
        if "year" in c:
            parts.append(base.format(step="split_year", on="true") + f" HAVING bool_or(contains({c}, '-'))")
    for c in numbers:
        step = "cast to int" if c.startswith("year") else "cast to float"
        parts.append(f"SELECT '{c}', '{step}', true FROM ({source}) HAVING count(*) > 0")
        parts.append(f"SELECT '{c}', 'bins', false FROM ({source}) HAVING count(DISTINCT {c}) > 0.2 * count(*)")
    return union_all(parts)


def _plan_rows(plan):
    for name, spec in plan["columns"].items():
        for step, suggested in spec["suggested"].items():
            shown = f"cast to {suggested['type']}" if step == "cast" else step
            yield name, shown, spec["enabled"][step]


@query("suggest_plan_part", _plan_sql(PARTS.sql, ["label", "tags", "years_made"], ["part_key", "size", "price"]))
def suggest_plan_part(spark, sf_dir):
    plan = transform.suggest_plan(PARTS.frame(spark, sf_dir), "part")
    return spark.createDataFrame(list(_plan_rows(plan)), "column string, step string, enabled boolean")


_DOCUMENTS = _plan_sql("SELECT *, 2000 + doc_id % 20 AS year_made FROM documents", ["text", "lang", "source"], ["doc_id", "n_chars", "year_made"])


@query("suggest_plan_documents", _DOCUMENTS)
def suggest_plan_documents(spark, sf_dir):
    df = table(spark, sf_dir, "documents").selectExpr("*", "2000 + doc_id % 20 AS year_made")
    plan = transform.suggest_plan(df, "documents")
    return spark.createDataFrame(list(_plan_rows(plan)), "column string, step string, enabled boolean")


_CAST_CELL = "CASE WHEN o_orderkey % 8 = 0 THEN 'unknown' ELSE concat(o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN '.5' ELSE '' END) END"


@query(
    "cast_numeric",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 8 <> 0 THEN o_custkey + CASE WHEN o_orderkey % 2 = 0 THEN 0.5::DOUBLE ELSE 0 END END AS as_float, "
    "CASE WHEN o_orderkey % 2 <> 0 THEN o_custkey END AS as_int FROM orders",
)
def cast_numeric(spark, sf_dir):
    cell = F.col("cell")
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_CAST_CELL} AS cell").select(
        "o_orderkey", transform.cast_number(cell, "text", "float").alias("as_float"),
        transform.cast_number(cell, "text", "int").alias("as_int"),
    )


def _bin_index(c: str) -> str:
    """Right-closed bins between distinct quantiles, counted from 0."""
    return (
        f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest(len(list_filter(edges, lambda e: e < {c})) - 1, 0) END"
    )


def _edges(c: str, source: str) -> str:
    return f"SELECT list_sort(list_distinct(quantile_cont({c}, [0, 0.25, 0.5, 0.75, 1]))) AS edges FROM ({source})"


@query(
    "quantile_bins",
    f"SELECT order_key, line, price, {_bin_index('price')} AS price_bin_index FROM ({LINES.sql}), ({_edges('price', LINES.sql)})",
)
def quantile_bins(spark, sf_dir):
    df = LINES.frame(spark, sf_dir).select("order_key", "line", "price")
    return transform.quantile_bins(df, ["price"])[0].select(
        "order_key", "line", "price", F.col("price_bin_index").cast("bigint").alias("price_bin_index")
    )


def _histogram_sql(c: str, source: str) -> str:
    return (
        f"SELECT '{c}_bin' AS \"column\", low, high, n FROM (SELECT edges[i + 1] AS low, edges[i + 2] AS high, n FROM "
        f"(SELECT {_bin_index(c)} AS i, count(*) AS n FROM ({source}), ({_edges(c, source)}) WHERE {c} IS NOT NULL GROUP BY 1), "
        f"({_edges(c, source)}))"
    )


@query("bin_histogram", _histogram_sql("quantity", LINES.sql) + " UNION ALL " + _histogram_sql("line", LINES.sql))
def bin_histogram(spark, sf_dir):
    df, edges = transform.quantile_bins(LINES.frame(spark, sf_dir).select("quantity", "line"), ["quantity", "line"])
    bounds = [
        (f"{c}_bin", label, low, high)
        for c, e in edges.items() for label, low, high in zip(transform.bin_labels(e), e, e[1:])
    ]
    shown = spark.createDataFrame(bounds, "column string, bin string, low double, high double")
    return report.bin_histogram(df).join(F.broadcast(shown), ["column", "bin"]).select("column", "low", "high", "n")


_PLAN = {
    "dataset": "part",
    "columns": {
        "price": {"suggested": {"cast": {"type": "float"}}, "enabled": {"cast": True, "bins": False}},
        "size": {"suggested": {"cast": {"type": "float"}}, "enabled": {"cast": True}},
        "tags": {"enabled": {"lowercase": True, "strip": True, "normalize_delimiters": True, "split_multi_values": True}},
        "years_made": {"enabled": {"split_year": True}},
        "absent": {"enabled": {"lowercase": True}},
    },
    "dataset_ops": {"filter": {"size": {">=": 5, "<=": 40}, "price": {">=": None, "<=": 1000}}},
}


@query(
    "apply_plan",
    rf"SELECT part_key, label, regexp_replace(regexp_replace(trim(lower(tags)), '[;:/]', ',', 'g'), '\s*,\s*', ',', 'g') AS tags, "
    "cast(size AS DOUBLE) AS size, price, years_made, cast(1950 + size AS bigint) AS years_made_start, "
    f"CASE WHEN size % 3 <> 0 THEN cast(1951 + size AS bigint) END AS years_made_end FROM ({PARTS.sql}) "
    "WHERE size BETWEEN 5 AND 40 AND price <= 1000",
)
def apply_plan(spark, sf_dir):
    return transform.apply_plan(PARTS.frame(spark, sf_dir), _PLAN).df


@query(
    "plan_filter",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 50000 AND 250000",
)
def plan_filter(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return transform.filter_rows(df, {"o_totalprice": {">=": 50000, "<=": 250000}, "o_orderkey": {">=": None}})


@query(
    "plan_groupby",
    "SELECT l_returnflag, l_linestatus, cast(sum(l_quantity) AS DOUBLE) AS l_quantity_sum, round(avg(l_discount), 8) AS l_discount_mean, "
    "count(l_tax) AS l_tax_count, min(l_extendedprice) AS l_extendedprice_min, max(l_extendedprice) AS l_extendedprice_max, "
    "count(DISTINCT l_suppkey) AS l_suppkey_nunique FROM lineitem GROUP BY 1, 2",
)
def plan_groupby(spark, sf_dir):
    df = transform.group_rows(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "l_quantity": "sum", "l_discount": "mean", "l_tax": "count",
        "l_extendedprice": ["min", "max"], "l_suppkey": "nunique",
    })
    return df.withColumn("l_discount_mean", F.round("l_discount_mean", 8))


_TAGS = "list_distinct(list_filter(list_transform(string_split_regex(lower(concat(p_brand, ';', p_type, ' / ', p_brand)), '[,;/:]'), lambda t: trim(t)), lambda t: t <> ''))"


@query(
    "group_by_list_value",
    f"SELECT tag AS tags, count(*) AS p_partkey_count, sum(p_size) AS p_size_sum FROM (SELECT p_partkey, p_size, unnest({_TAGS}) AS tag FROM part "
    "WHERE p_size >= 10) GROUP BY tag",
)
def group_by_list_value(spark, sf_dir):
    """A plan that makes lists of multi-valued cells and groups by their values; the lists go through a stored table."""
    df = table(spark, sf_dir, "part").withColumn("tags", F.expr("concat(p_brand, ';', p_type, ' / ', p_brand)"))
    steps = {"lowercase": {}, "normalize_delimiters": {}, "split_multi_values": {"as": "list"}}
    plan = {"dataset": "part", "columns": {"tags": {"suggested": steps, "enabled": dict.fromkeys(steps, True)}}}
    listed = transform.apply_plan(df, json.loads(json.dumps(plan))).df
    name = tables.write_table(listed, f"part_{uuid.uuid4().hex[:8]}")
    operations = {"filter": {"p_size": {">=": 10}}, "groupby": {"by": ["tags"], "agg": {"p_partkey": "count", "p_size": "sum"}}}
    return transform.apply_plan(spark.table(name), {"columns": {}, "dataset_ops": operations}).df
