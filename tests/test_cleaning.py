import datetime

import pytest
from pyspark.sql import functions as F

from sluicebox.operators import columns, dedup, missing, outliers, profile, schema, standardize, validate
from sluicebox.operators.profile import ROW_ORDER


def rows(df):
    return [tuple(r) for r in df.collect()]


def is_structural_name(name):
    return validate.is_structural(profile.ColumnStats(name, "text"))


def test_column_names(spark):
    raw = ["Adjusted gross (in 2022 dollars)", "Year(s)", None, " A&W ", "a", "a", "__x--y__", "Größe", "?", "a.1"]
    assert columns.clean_names(columns.header_names(raw)) == [
        "adjusted_gross_in_2022_dollars", "year_s", "unnamed_2", "a_w", "a", "a_1", "x_y", "größe", "unnamed_8", "a_1_2"]
    df = spark.createDataFrame([(1, 2, 3)], "`A b` int, `a-B` int, `_row_ord` int")
    assert columns.rename_clean(df).columns == ["a_b", "a_b_2", ROW_ORDER]


def test_shape_and_preview(spark):
    df = spark.range(30).withColumn("v", F.col("id") * 2).withColumn(ROW_ORDER, -F.col("id"))
    assert columns.shape(df) == ((30, 2), 30, 2)
    assert [r["id"] for r in columns.preview(df, 3).collect()] == [29, 28, 27]
    assert columns.preview(df.drop(ROW_ORDER), 5).count() == 5


def test_sparse_is_strictly_above(spark):
    df = spark.range(10).select(
        F.when(F.col("id") < 2, 1).alias("at_limit"), F.when(F.col("id") < 1, 1).alias("above"), F.lit(None).cast("int").alias("empty"),
    )
    assert columns.drop_sparse_columns(df)[1] == ["above", "empty"]
    assert columns.drop_empty_columns(df)[1] == ["empty"]


def test_date_route_alone(spark):
    df = spark.createDataFrame([("\t2024-01-02",), ("\t2024-02-03",), (None,)], "d string")
    done = standardize.standardize(df)
    assert done.routes == {"d": "date"}
    assert [r[0] for r in done.df.collect()] == [datetime.datetime(2024, 1, 2), datetime.datetime(2024, 2, 3), None]


def test_numeric_ids_stay_whole_numbers(spark):
    df = spark.range(50).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("double").alias("v"))
    done = standardize.standardize(df)
    assert done.routes == {"row_id": "id", "v": "keep"} and dict(done.df.dtypes)["row_id"] == "bigint"
    assert dict(missing.impute(done.df).df.dtypes)["row_id"] == "bigint"


def test_digits_beyond_a_double_stay(spark):
    big = 1200000000000000000
    df = spark.createDataFrame([(str(big + 251 * k), str(k) + ".5", str(k)) for k in range(20)] + [(None, "1", None)], "a string, b string, c string")
    done = missing.impute(df)
    assert dict(done.df.dtypes) == {"a": "bigint", "b": "double", "c": "double"}
    assert {r["a"] for r in done.df.collect()} == {big + 251 * k for k in range(20)}
    again = profile.collect_stats(done.df, groups=("numbers",))
    assert {c: s.kind for c, s in again.items()} == {c: s.kind for c, s in done.stats.items()}


def test_drop_and_fill(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("-", float("nan"), None), (None, 2.0, 6)], "t string, d double, n int")
    assert rows(missing.drop_null_rows(df)) == [("a", 1.0, 5)]
    assert rows(missing.fill_constant(df, 0)) == [("a", 1.0, 5), ("0", 0.0, 0), ("0", 2.0, 6)]
    assert rows(missing.fill_constant(df, "x")) == [("a", "1.0", "5"), ("x", "x", "x"), ("x", "2.0", "6")]
    assert rows(missing.handle_missing(df, "fill")) == [("a", 1.0, 5), (None, None, None), (None, 2.0, 6)]
    assert rows(missing.handle_missing(df, "no such")) == [("a", 1.0, 5), (None, None, None), (None, 2.0, 6)]


def test_impute(spark):
    df = spark.createDataFrame(
        [("10", "1", 2000, "x", None), ("2", "2", None, "nan", None), (None, "z", 2001, "x", None),
         (None, "3", 2002, "y", None), (None, "3", 2003, None, None)],
        "few string, mostly string, year int, word string, empty string",
    )
    done = missing.impute(df)
    assert rows(done.df) == [
        ("10", 1.0, 2000, "x"), ("2", 2.0, None, "x"), ("10", 3.0, 2001, "x"), ("10", 3.0, 2002, "y"), ("10", 3.0, 2003, "x")]
    assert done.dropped == ["empty"] and done.coerced == ["mostly"]
    assert (done.numeric, done.text, done.datetime) == (2, 2, 0)


def test_impute_counts_what_it_filled(spark):
    """The counts carried through equal the counts of the imputed table."""
    df = spark.createDataFrame(
        [("1", "yes", "2024-01-02", 3.5, "AB-1234567"), (None, "no", "2024-01-02", None, None), ("x", None, None, 2.0, "CD-7654321"),
         ("1", "yes", "2024-01-03", 2.0, "AB-1234567"), ("4", "yes", "soon", 2.0, "-")],
        "n string, b string, d string, f double, i string",
    )
    groups = standardize.LASTING_GROUPS
    done = missing.impute(df, groups=groups)
    again = profile.collect_stats(done.df, groups=groups, parse_dates=False)
    for name, s in again.items():
        assert (done.stats[name].filled, done.stats[name].kind) == (s.filled, s.kind), name
        assert {k: done.stats[name].counts[k] for k in s.counts} == s.counts, name
        assert (done.stats[name].low, done.stats[name].high) == (s.low, s.high), name


def test_kept_columns_are_not_measured_again(spark):
    df = spark.createDataFrame(
        [("$1", "a", " b ", 1, "2001-2002"), ("$2", "nan", "c", 2, "2001-2003"), ("$3K", "-", "--", 2, "2004"), (None, "d", "e", None, "2001-2002")],
        "money string, word string, blank string, n int, span string",
    )
    standard = standardize.standardize(df, profile.collect_stats(df, groups=standardize.PROFILE_GROUPS, parse_dates=False))
    assert standard.routes == {"money": "numeric", "word": "strip", "blank": "strip", "n": "keep", "span": "year"}
    carried = standardize.lasting_stats(standard)
    again = profile.collect_stats(missing.normalize_missing(standard.df), groups=standardize.LASTING_GROUPS, parse_dates=False)
    for name, s in again.items():
        assert (carried[name].filled, carried[name].kind) == (s.filled, s.kind), name
        assert {k: carried[name].counts[k] for k in s.counts} == s.counts, name


def test_apply_schema(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "YES", "2024-01-02", "a", "9007199254740993"), ("2.0", "x", "no", "2024-01-03", "b", "1"), (None, "2", "1", "bad", "a", "2")],
        "i string, f string, b string, d string, c string, large string",
    )
    wanted = {"i": "integer", "f": "float", "b": "boolean", "d": "datetime", "c": "category", "large": "integer", "gone": "text"}
    done = schema.apply_schema(df, wanted)
    day = datetime.datetime
    assert rows(done.df) == [
        (1, 1.5, True, day(2024, 1, 2), "a", 9007199254740993), (2, None, False, day(2024, 1, 3), "b", 1), (None, 2.0, True, None, "a", 2)]
    assert done.df.schema["c"].metadata == {"logical": "category"}
    assert {c: s.nulls for c, s in done.stats.items()} == {"i": 1, "f": 1, "b": 0, "d": 1, "c": 0, "large": 0}
    strict = schema.apply_schema(df, wanted, strict_boolean=True)
    assert dict(strict.df.dtypes)["b"] == "string" and len(strict.warnings) == 1


def test_integers_fall_back_to_double(spark):
    df = spark.createDataFrame([("1.5", "1e30", "inf"), ("2", "5", "2")], "half string, huge string, infinite string")
    done = schema.apply_schema(df, dict.fromkeys(df.columns, "integer"))
    assert {t for _, t in done.df.dtypes} == {"double"}


def test_outliers(spark):
    df = spark.createDataFrame([(float(v), 3, str(v)) for v in [1, 2, 3, 4, 100]] + [(None, 3, None)], "v double, same int, txt string")
    bounds = outliers.quartile_bounds(df, ["v", "same"])
    assert bounds["v"] == (1.0, 2.0, 3.0, 4.0, 100.0, -1.0, 7.0) and bounds["same"][5:] == (None, None)
    assert [r[0] for r in outliers.clip_outliers(df, ["v", "same"]).collect()] == [1.0, 2.0, 3.0, 4.0, 7.0, None]
    assert [r["v_outlier"] for r in outliers.outlier_flags(df, ["v"]).collect()] == [False] * 4 + [True, False]
    box = {r["column"]: r for r in outliers.boxplot_stats(df, ["v", "same", "txt"]).collect()}
    assert box["v"]["outliers"] == 1 and box["v"]["whisker_high"] == 7.0 and box["v"]["filled"] == 5
    assert box["txt"]["outliers"] == 1 and box["same"]["outliers"] == 0 and box["same"]["whisker_high"] == 3.0
    assert outliers.eligible_by_values(df) == ["v", "txt"]
    years = df.withColumnsRenamed({"v": "year_v", "txt": "byr"})
    assert outliers.eligible_by_values(years) == []
    assert outliers.eligible_by_schema(years, {"year_v": "float", "same": "integer", "gone": "float", "byr": "text"}) == ["same"]


# --- duplicates

def test_guard_is_strictly_above(spark):
    df = spark.range(10).select(F.col("id"), F.when(F.col("id") < 4, 0).otherwise(F.col("id")).alias("k"))
    done = dedup.remove_duplicates(df, ["k"], order_by="id")
    assert done.status.executed and done.status.removed == 3 and done.df.count() == 7
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") < 32, 0).otherwise(F.col("id")).alias("k"))
    done = dedup.remove_duplicates(df, ["k"], order_by="id")
    assert done.status.aborted and done.status.removed == 0 and done.df.count() == 100
    assert done.status.reason == "Aborted: 31.0% rows would be removed"


def test_keep_and_null_keys(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "x", "c"), (4, "y", "d"), (5, "x", "e")], "i int, k string, v string")
    assert {r["i"] for r in dedup.keep_one(df, ["k"], "first", "i").collect()} == {1, 3, 4}
    assert {r["i"] for r in dedup.keep_one(df, ["k"], "last", "i").collect()} == {2, 5, 4}
    assert {r["i"] for r in dedup.keep_one(df, ["k"], False, "i").collect()} == {4}
    assert dedup.duplicate_counts(df, ["k"]).first().asDict() == {"rows": 5, "groups": 3, "duplicates": 2}
    assert dedup.remove_duplicates(df, ["k"], keep=False, order_by="i", limit=1.0).status.removed == 4
    assert dedup.keep_one(df, ["k"], "first", "i").columns == df.columns


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("keep", ["first", "last", False])
def test_repeats_by_hash(spark, threshold, keep):
    """A hot key, gaps in different places, signed zeros, long keys; with and without a broadcast of what repeats."""
    rows = [(k, None if k % 10 == 3 else f"{'key ' * 100}{min(k, 400) if k < 500 else k}", -0.0 if k % 2 else 0.0, "x" if k % 7 else None) for k in range(900)]
    rows += [(900, None, 1.0, "x"), (901, "x", 1.0, None)]
    df = spark.createDataFrame(rows, "i int, k string, d double, e string").repartition(7)
    keys = ["k", "d", "e"]
    first: dict[tuple, list[int]] = {}
    for i, *key in rows:
        first.setdefault(tuple(key), []).append(i)
    wanted = {ids[0] if keep == "first" else ids[-1] for ids in first.values() if keep or len(ids) == 1}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        done = dedup.remove_duplicates(df, keys, keep=keep, order_by="i", limit=1.0)
        got = done.df.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["i"] for r in got} == wanted and len(got) == len(wanted) == 902 - done.status.removed
    assert done.df.columns == df.columns
    assert dedup.duplicate_counts(df, keys).first()["groups"] == len(first)


def test_one_shuffle_of_the_keys(spark):
    """Counting writes what repeats; rows whose key is their own are not shuffled again."""
    df = spark.range(2000).select("id", (F.col("id") % 1900).alias("k"), F.lit("wide " * 20).alias("w"))
    done = dedup.remove_duplicates(df, ["k"], order_by="id")
    plan = done.df._jdf.queryExecution().executedPlan().toString()
    assert done.status.removed == 100 and done.df.count() == 1900
    assert plan.count("hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_no_keys(spark):
    df = spark.range(5).select(F.col("id").alias("n"), F.lit(1).alias("v"))
    done = dedup.remove_duplicates(df, schema={"n": "integer", "v": "integer"})
    assert done.status.keys is None and done.status.reason == "No valid deduplication keys" and done.df is df
    assert dedup.remove_duplicates(df, ["gone"]).status.keys is None


def test_derived_keys(spark):
    df = spark.range(100).select(
        F.concat(F.lit("u"), F.col("id") % 50).alias("half"), F.col("id").cast("string").alias("every"), F.lit("x").alias("one"),
        (F.col("id") % 5 + 2000).alias("make_year"), F.concat(F.lit("w"), F.col("id") % 40).alias("more"),
        F.concat(F.lit("z"), F.col("id") % 60).alias("fourth"), F.col("id").alias("some_id"),
    )
    types = {"half": "text", "every": "text", "one": "category", "make_year": "integer", "more": "text", "fourth": "text", "some_id": "integer"}
    assert dedup.derive_keys(df, types) == ["some_id"]
    assert dedup.derive_keys(df.drop("some_id"), types) == ["half", "make_year", "more"]
    assert dedup.derive_keys(df.drop("some_id"), types, year_names=False) == ["half", "more", "fourth"]


def test_full_row(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 3), (2, None, 1), (2, None, 2)], f"x int, y string, {ROW_ORDER} int")
    assert sorted(rows(dedup.drop_repeated_rows(df)), key=str) == [(1, "a", 3), (2, None, 1)]
    assert dedup.drop_repeated_rows(df.drop(ROW_ORDER)).count() == 2


# --- checks

def test_validation(spark):
    df = spark.createDataFrame([(1, "a", 2000, None), (2, None, None, None), (2, "c", 2001, 5)], "k int, t string, made int, x_end int")
    status = dedup.DedupStatus(executed=True, keys=["k"])
    done = validate.validate(df, "d", {"k": "integer", "gone": "text"}, status, rows_before=6)
    found = done.as_dict()
    assert found["status"] == "FAIL"
    checks = {n: (c["status"], c["message"]) for n, c in found["checks"].items()}
    assert checks["non_empty"] == ("PASS", "Dataset contains 3 rows after cleaning")
    assert checks["schema_match"] == ("FAIL", "Missing columns: ['gone']")
    assert checks["deduplication"] == ("FAIL", "1 duplicate rows remain for keys=['k']")
    assert checks["unexpected_nulls_t"] == ("FAIL", "Found 1 unexpected null values")
    assert checks["no_nulls"] == ("FAIL", "Found 1 unexpected null values")
    assert checks["row_drop_ratio"] == ("FAIL", "Dropped 50.0% of rows")
    assert {r["check"] for r in done.as_frame(spark).collect()} == set(checks)


def test_structural_gaps_are_fine(spark):
    df = spark.createDataFrame([(2000, None), (None, None), (2001, 5)], "made int, x_end int")
    found = validate.validate(df, "d", {"made": "integer"}).as_dict()
    assert found["status"] == "PASS"
    assert found["checks"]["no_nulls"]["message"] == "Only structural nulls found (3); expected"
    assert found["checks"]["deduplication"]["message"] == "Deduplication not executed"
    skipped = validate.validate(df, "d", {}, dedup.DedupStatus(reason="No valid deduplication keys")).as_dict()
    assert skipped["checks"]["deduplication"]["message"] == "Deduplication skipped intentionally: No valid deduplication keys"


def test_empty_table_fails(spark):
    df = spark.createDataFrame([], "a int")
    found = validate.validate(df, "d", {}, rows_before=0).as_dict()
    assert found["status"] == "FAIL" and "row_drop_ratio" not in found["checks"]
    assert found["checks"]["no_nulls"]["status"] == "PASS"


def test_smaller_checks(spark):
    df = spark.createDataFrame([(" a", None), ("b", None), ("c", 1)], "t string, n int")
    assert validate.null_ratio_check(df) == {"n": pytest.approx(2 / 3)}
    assert [tuple(r) for r in validate.edge_blanks(df).collect()] == [("t", 1)]
    assert is_structural_name("Year_End") and not is_structural_name("end_year")
