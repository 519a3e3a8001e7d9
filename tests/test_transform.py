import json

import pytest
from pyspark.sql import functions as F

from sluicebox.operators import report, transform


def plan_of(**columns):
    return {"dataset": "d", "columns": {c: {"suggested": s.get("suggested", {}), "enabled": s["enabled"]} for c, s in columns.items()}}


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("A; B", 1, 1.5, "2018-2020", True), ("c", 2, 2.5, "2019", False), ("D:e", 3, 2.5, "2020-2021", True), (None, 4, None, None, None)],
        "tags string, n int, f double, year_span string, flag boolean",
    )


def test_suggestions(table):
    plan = transform.suggest_plan(table, "d")
    assert list(plan["columns"]) == ["tags", "n", "f", "year_span", "flag"]
    assert plan["columns"]["tags"] == {
        "suggested": {
            "lowercase": {"reason": "Text column detected", "default": True},
            "strip": {"reason": "Leading/trailing spaces possible", "default": True},
            "normalize_delimiters": {"reason": "Multiple delimiters detected (; / : ,)", "default": True},
            "split_multi_values": {"reason": "Multi-valued text detected (skills/tags)", "default": False},
        },
        "enabled": {"lowercase": True, "strip": True, "normalize_delimiters": True, "split_multi_values": False},
    }
    assert plan["columns"]["n"]["suggested"]["cast"] == {"type": "float", "reason": "Numeric column", "default": True}
    assert plan["columns"]["n"]["enabled"] == {"cast": True, "bins": False}
    assert "split_year" in plan["columns"]["year_span"]["suggested"]
    assert "cast" in plan["columns"]["flag"]["suggested"]
    assert all(all(s["enabled"].values()) for s in transform.suggest_plan(table, "d", enable_all=True)["columns"].values())
    json.dumps(plan)


def test_year_columns_are_cast_to_int(spark):
    df = spark.createDataFrame([(2000.0, 1), (2001.5, 1), (None, 1)], "year_made double, same int")
    plan = transform.suggest_plan(df, "d")
    assert plan["columns"]["year_made"]["suggested"]["cast"]["type"] == "int"
    assert "bins" not in transform.suggest_plan(spark.range(10).select((F.col("id") % 2).alias("n")), "d")["columns"]["n"]["suggested"]
    assert [r[0] for r in transform.apply_plan(df, plan).df.collect()] == [2000, None, None]


def test_steps_and_report(table):
    every = {"lowercase": True, "strip": True, "normalize_delimiters": True, "split_multi_values": True}
    plan = plan_of(
        tags={"enabled": every}, n={"suggested": {"cast": {"type": "int"}}, "enabled": {"cast": True, "bins": True}},
        f={"enabled": {"cast": True}}, year_span={"enabled": {"split_year": True}}, gone={"enabled": {"lowercase": True}},
        flag={"enabled": {"cast": True}},
    )
    done = transform.apply_plan(table, plan)
    got = [tuple(r) for r in done.df.collect()]
    assert got == [
        ("a,b", 1, 1.5, "2018-2020", 1.0, 2018, 2020, "(0.999, 1.75]"), ("c", 2, 2.5, "2019", 0.0, 2019, None, "(1.75, 2.5]"),
        ("d,e", 3, 2.5, "2020-2021", 1.0, 2020, 2021, "(2.5, 3.25]"), (None, 4, None, None, None, None, None, "(3.25, 4.0]")]
    assert done.df.columns == ["tags", "n", "f", "year_span", "flag", "year_span_start", "year_span_end", "n_bin"]
    assert done.report["column_transformations"] == {
        "tags": ["lowercase", "strip", "normalize_delimiters"], "n": ["cast_to_numeric", "bins_created"],
        "f": ["cast_to_numeric"], "year_span": ["split_year"], "flag": ["cast_to_numeric"]}
    assert done.report["generated_columns"] == ["year_span_start", "year_span_end", "n_bin"]


def test_no_plan(table):
    assert transform.apply_plan(table, None).df is table
    assert transform.apply_plan(table, {}).report == {}


def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, 1, 1, 2, 3, 4, None]], "v int")
    done, edges = transform.quantile_bins(df, ["v"])
    assert edges["v"] == [1.0, 2.5, 4.0]
    assert [tuple(r)[1:] for r in done.collect()] == [("(0.999, 2.5]", 0)] * 5 + [("(2.5, 4.0]", 1)] * 2 + [(None, None)]
    assert [tuple(r) for r in report.sorted_histogram(report.bin_histogram(done)).collect()] == [
        ("v_bin", "(0.999, 2.5]", 5), ("v_bin", "(2.5, 4.0]", 2)]
    same, edges = transform.quantile_bins(spark.createDataFrame([(1,), (1,)], "v int"), ["v"])
    assert same.columns == ["v"] and edges["v"] == [1.0]


def test_bin_labels():
    assert transform.bin_labels([0.0, 0.25, 1.0]) == ["(-0.001, 0.25]", "(0.25, 1.0]"]
    assert transform.bin_labels([1.00001, 1.00002, 1.5]) == ["(1.0, 1.00002]", "(1.00002, 1.5]"]
    assert transform.bin_labels([1234.5678, 2000.0, 3000.0])[1] == "(2000.0, 3000.0]"
    assert len(set(transform.bin_labels([1.00001, 1.00002, 1.00003]))) == 2


def test_filter(spark):
    df = spark.range(10)
    assert [r[0] for r in transform.filter_rows(df, {"id": {">=": 3, "<=": 5}}).collect()] == [3, 4, 5]
    assert transform.filter_rows(df, {"id": {">=": None, "<=": None}}).count() == 10
    with pytest.raises(ValueError):
        transform.filter_rows(df, {"gone": {">=": 1}})
    with pytest.raises(ValueError):
        transform.filter_rows(df, {"id": {"~": 1}})


def test_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None)], "k string, v int")
    got = {r["k"]: tuple(r)[1:] for r in transform.group_rows(df, ["k"], {"v": ["sum", "mean", "count", "nunique"]}).collect()}
    assert got == {"a": (4, 2.0, 2, 2), "b": (None, None, 0, 0)}
    assert transform.group_rows(df, [], {"v": "sum"}) is df
    assert transform.group_rows(df, ["k"], {}).count() == 2
    with pytest.raises(ValueError):
        transform.group_rows(df, ["k"], {"v": "no such"})


def test_table_wide_operations_in_a_plan(table):
    plan = {"columns": {}, "dataset_ops": {"filter": {"n": {"<=": 3}}, "groupby": {"by": ["flag"], "agg": {"f": "max"}}}}
    done = transform.apply_plan(table, plan, "d")
    assert {tuple(r) for r in done.df.collect()} == {(True, 2.5), (False, 2.5)}
    assert set(done.report["dataset_operations"]) == {"filter", "groupby"}
    empty = transform.apply_plan(table, {"columns": {}, "dataset_ops": {"groupby": {"by": [], "agg": {}}}})
    assert empty.df.count() == 4 and empty.report["dataset_operations"] == {}


# --- reports

def test_reports(spark, table):
    assert {tuple(r) for r in report.missing_counts(table).collect()} == {("tags", 1), ("f", 1), ("year_span", 1), ("flag", 1)}
    full = spark.createDataFrame([(1, "a")], "x int, y string")
    assert {tuple(r) for r in report.missing_counts(full).collect()} == {("x", 0), ("y", 0)}
    assert report.headline(table).first().asDict() == {"rows": 4, "columns": 5, "missing": 4}
    assert {r["column"]: r["null_percent"] for r in report.null_percent(table).collect()}["f"] == 25.0
    gaps = spark.createDataFrame([(None, None, 1)], "year_end int, other_end int, year_x_end int")
    assert report.year_end_notice(gaps) == ["year_end"]


def test_describe(spark, table):
    df = table.withColumn("at", F.lit("1970-01-01 00:01:00").cast("timestamp"))
    got = {r["column"]: r.asDict() for r in report.describe(df).collect()}
    assert got["tags"]["count"] == 3 and got["tags"]["unique"] == 3 and got["tags"]["freq"] == 1 and got["tags"]["top"] == "A; B"
    assert got["flag"]["top"] == "true" and got["flag"]["freq"] == 2
    assert (got["n"]["mean"], got["n"]["min"], got["n"]["q25"], got["n"]["q50"], got["n"]["max"]) == (2.5, 1.0, 1.75, 2.5, 4.0)
    assert got["f"]["count"] == 3 and got["f"]["std"] == pytest.approx(0.5773502691896258)
    assert got["at"]["min"] == 60.0


def test_lists_in_a_plan(spark):
    """Multi-values as lists, filtered and grouped by their values."""
    df = spark.createDataFrame([(1, " A;b / a", 5), (2, "B", 7), (3, None, 9), (4, " ; ", 1), (5, "c,c", 2)], "i int, t string, n int")
    plan = {"columns": {"t": {"suggested": {"split_multi_values": {"as": "list"}}, "enabled": {"split_multi_values": True, "split_year": True}}}}
    done = transform.apply_plan(df, plan)
    assert [r["t"] for r in done.df.orderBy("i").collect()] == [["a", "b", "a"], ["b"], None, [], ["c", "c"]]
    assert done.report["column_transformations"] == {"t": ["split_to_list"]} and done.report["generated_columns"] == []
    plan["dataset_ops"] = {"groupby": {"by": ["t"], "agg": {"n": "sum"}}}
    assert {tuple(r) for r in transform.apply_plan(df, plan).df.collect()} == {("a", 5), ("b", 12), ("c", 2)}
    plan["dataset_ops"] = {"filter": {"t": {"contains": "b"}}}
    assert {r["i"] for r in transform.apply_plan(df, plan).df.collect()} == {1, 2}
    with pytest.raises(ValueError):
        transform.filter_rows(df, {"n": {"contains": 5}})
