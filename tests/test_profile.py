import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluicebox.operators import profile, quantiles, schema, sketches, standardize
from sluicebox.operators.profile import ColumnStats


def stats_of(spark, cells, column_type="string", groups=profile.ALL_GROUPS, name="c"):
    df = spark.createDataFrame([(c,) for c in cells], f"`{name}` {column_type}")
    return profile.collect_stats(df, groups=groups)[name]


def test_counts_of_text(spark):
    s = stats_of(spark, ["$1,0", "x [a]", "2019-2020", "12K", None, "abc", "-", "1.5", "yes", " e"])
    assert (s.rows, s.filled, s.nulls) == (10, 9, 1)
    assert s.counts["text_dirty"] == 1 and s.counts["money_dirty"] == 2
    assert s.counts["year"] == 1 and s.counts["year_range"] == 1
    assert s.counts["letters"] == 5 and s.counts["plain_number"] == 1
    assert s.counts["parsed"] == 1 and s.counts["whole"] == 0
    assert s.counts["boolean_word"] == 1 and s.counts["missing_word"] == 1
    assert s.counts["edge_space"] == 1 and s.counts["edge_blank"] == 1
    assert s.counts["dash"] == 2 and s.counts["delimiter"] == 1


def test_counts_of_numbers(spark):
    s = stats_of(spark, [1999.0, 2001.5, float("nan"), float("inf"), None, 0.0], "double")
    assert (s.rows, s.filled) == (6, 4)
    assert s.counts["parsed"] == 4 and s.counts["whole"] == 2 and s.counts["infinite"] == 1
    assert s.counts["in_years"] == 2 and (s.low, s.high) == (0.0, 2001.5)
    assert s.counts["boolean_word"] == 0
    assert stats_of(spark, [0, 1, 1, None], "int").counts["boolean_word"] == 3
    assert stats_of(spark, [True, None, False], "boolean").counts["boolean_word"] == 2
    assert stats_of(spark, [20202021, 20192020, 5], "bigint").counts["year_range"] == 2


def test_empty_table(spark):
    s = stats_of(spark, [])
    assert (s.rows, s.filled, s.null_ratio, s.of_rows("parsed"), s.of_filled("letters")) == (0, 0, 0.0, 0.0, 0.0)


def test_other_kinds_count_gaps(spark):
    df = spark.createDataFrame([([1], None), (None, {"a": 1}), ([2], None)], "a array<int>, m map<string,int>")
    found = profile.collect_stats(df, groups=("numbers", "dirt"))
    assert found["a"].nulls == 1 and found["m"].nulls == 2


def test_odd_column_names(spark):
    df = spark.createDataFrame([("x", 1)], "`a.b` string, `c``d e` int")
    assert list(profile.collect_stats(df)) == ["a.b", "c`d e"]
    assert profile.distinct_counts(df, df.columns) == {"a.b": 1, "c`d e": 1}


def test_values_group_skips_text(spark):
    df = spark.createDataFrame([("1", 2000), ("2", None)], "t string, n int")
    found = profile.collect_stats(df, groups=("values",))
    assert found["t"].counts["parsed"] == 0 and found["n"].counts["in_years"] == 1


def test_distinct_counts_are_exact(spark):
    n = 20_000
    df = spark.range(n).select(
        F.col("id").alias("all"), (F.col("id") % 2000).alias("tenth"), (F.col("id") % 10).alias("few"),
    )
    assert profile.distinct_counts(df, df.columns) == {"all": n, "tenth": 2000, "few": 10}


def test_distinct_keeps_long_texts_and_large_integers_apart(spark):
    long = "x" * 500
    df = spark.createDataFrame([(long + "a", 2 ** 60), (long + "b", 2 ** 60 + 1), (long + "a", None)], "t string, n bigint")
    assert profile.distinct_counts(df, ["t", "n"]) == {"t": 2, "n": 2}


def test_modes(spark):
    df = spark.createDataFrame(
        [("10", 2.5, 7, True, 1), ("2", 2.5, 3, None, 2), ("2", 1.5, 3, False, None), ("10", 1.5, None, True, None), (None, None, 9, True, None)],
        "t string, d double, n bigint, b boolean, x int",
    ).withColumn("ts", F.when(F.col("b"), F.lit("2024-01-02").cast("timestamp_ntz"))).withColumn("none", F.lit(None).cast("string"))
    modes = profile.collect_modes(df, df.columns)
    assert "none" not in modes
    row = spark.range(1).select(*[v.alias(c) for c, v in modes.items()]).first().asDict()
    assert row["t"] == "10" and row["d"] == 1.5 and row["n"] == 3 and row["b"] is True and row["x"] == 1
    assert str(row["ts"]) == "2024-01-02 00:00:00"
    types = dict(spark.range(1).select(*[v.alias(c) for c, v in modes.items()]).dtypes)
    assert types["n"] == "bigint" and types["x"] == "int" and types["ts"] == "timestamp_ntz"


@pytest.mark.parametrize("bound", [10 ** 9, 50, 2])
def test_quantiles_agree_on_every_path(spark, bound):
    import numpy as np

    rng = random.Random(7)
    smooth = [rng.gauss(0, 1) for _ in range(4000)]
    hot = [5.0] * 3000 + [rng.random() for _ in range(999)] + [float(10 ** 9)]
    gaps = [None if i % 3 else float(i % 17) for i in range(4000)]
    df = spark.createDataFrame(list(zip(smooth, hot, gaps)), "smooth double, hot double, gaps double").repartition(4)
    df = df.withColumn("none", F.lit(None).cast("double"))
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = quantiles.exact_quantiles(df, df.columns, probabilities, bound=bound)
    for name, values in (("smooth", smooth), ("hot", hot), ("gaps", [v for v in gaps if v is not None])):
        assert found[name] == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12, abs=1e-12)
    assert found["none"] == [None] * len(probabilities)


def test_quantiles_in_more_groups_than_one_job_takes(spark):
    df = spark.range(300).select(*[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(1, 130)])
    found = quantiles.exact_quantiles(df, df.columns, (0.5,), bound=5)
    assert all(found[f"c{i}"] == [149.5 * i] for i in range(1, 130))


# --- decisions on counts alone

def made(name="c", rows=100, filled=100, kind="text", distinct=None, low=None, high=None, **counts):
    base = dict.fromkeys(["parsed", "whole", "infinite", "in_years", "boolean_word", "date_like"], 0)
    return ColumnStats(name, kind, rows, filled, {**base, **counts}, low, high, distinct)


def test_id_needs_two_signals():
    assert standardize.name_looks_like_id("User_ID") and standardize.name_looks_like_id("uuid")
    assert not standardize.name_looks_like_id("idea") and not standardize.name_looks_like_id("grid")
    assert standardize.is_id(made("x_id", distinct=95))
    assert not standardize.is_id(made("x_id", distinct=94))
    assert not standardize.is_id(made("x", distinct=100))
    assert standardize.is_id(made("x", distinct=95, id_value=90))
    assert standardize.is_id(made("x_id", id_value=90))
    assert not standardize.is_id(made("x", distinct=95, id_value=89))


def test_router_order_and_edges():
    r = standardize.route
    assert r(made("x_id", distinct=100, year_range=100, money_dirty=100)) == "id"
    assert r(made(text_dirty=60, date_iso_date=60, year_range=100)) == "date"
    assert r(made(text_dirty=59, date_iso_date=60, year_range=60)) == "year"
    assert r(made(year_range=59, money_dirty=10)) == "numeric"
    assert r(made(money_dirty=9, letters=60, plain_number=19)) == "strip"
    assert r(made(money_dirty=9, letters=60, plain_number=20)) == "keep"
    assert r(made(letters=59)) == "keep"
    assert r(made(letters=60, text_dirty=60)) == "text"
    assert r(made(filled=0)) == "keep"


def test_type_order_and_edges():
    t = schema.detected_type
    assert t(made(filled=0)) == "text"
    assert t(made(boolean_word=100, parsed=100, whole=100)) == "boolean"
    assert t(made(boolean_word=99, parsed=95, whole=95)) == "integer"
    assert t(made(parsed=100, whole=99)) == "integer"
    assert t(made(parsed=100, whole=98)) == "float"
    assert t(made(parsed=94, date_iso_date=95)) == "datetime"
    assert t(made(distinct=10)) == "category"
    assert t(made(distinct=11)) == "text"
    assert t(made(kind="time")) == "datetime"


def _plain_mode(values):
    counts = Counter(v for v in values if v is not None)
    most = max(counts.values())
    return min(v for v, n in counts.items() if n == most), most


def test_modes_of_every_sort(spark):
    """One value stands out, ties, twice at most, all unique, long texts; more distinct values than a summary keeps."""
    rng = random.Random(6)
    n = 12_000
    columns = {
        "hot": [f"v{rng.randrange(9000)}" if rng.random() < 0.9 else "the hot one" for _ in range(n)],
        "tied": [k % 3000 if k % 4 else k % 2 for k in range(n)],
        "pairs": [f"{'long ' * 50}{k // 2 if k < 4000 else k}" for k in range(n)],
        "unique": [f"unique {n - k}" for k in range(n)],
        "number": [float(rng.randrange(5000)) if rng.random() < 0.5 else 0.5 for _ in range(n)],
        "gaps": [None if k % 3 else k % 5 == 0 for k in range(n)],
        "few": ["é" if k % 2 else "z" for k in range(n)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), "hot string, tied bigint, pairs string, unique string, number double, gaps boolean, few string")
    df = df.repartition(37)
    found = profile.modes(df, df.columns)
    for name, values in columns.items():
        row = found[name]
        value, times = _plain_mode(values)
        assert row["n"] == times and next(v for v in (row["whole"], row["num"], row["txt"]) if v is not None) == value, name
    assert profile.modes(df.select(F.lit(None).cast("string").alias("x")), ["x"]) == {} and profile.modes(df.limit(0), ["hot"]) == {}


def test_no_texts_are_shuffled_for_unique_columns(spark, monkeypatch):
    """A column of unique values and one with a clear mode go without a shuffle of values and without a join."""
    plans = []
    original = type(spark.range(1)).collect

    def collect(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return original(df)
    df = spark.range(3000).selectExpr("concat('a long unique text ', id) AS u", "CASE WHEN id % 3 = 0 THEN concat('x', id) ELSE 'mode' END AS m")
    monkeypatch.setattr(type(df), "collect", collect)
    found = profile.modes(df, ["u", "m"])
    assert found["u"]["txt"] == "a long unique text 0" and found["m"]["txt"] == "mode" and found["m"]["n"] == 2000
    assert len(plans) == 4 and not any("Join" in p for p in plans)
    assert "hashpartitioning(column" in plans[2] and "txt" not in plans[2].split("Exchange")[1].split("\n")[0]


def test_summaries_merge_in_levels(spark):
    df = spark.range(0, 50_000, 1, 200).selectExpr("id % 3 AS k", "cast(id AS double) AS v", "CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS h")
    row = {r["k"]: r for r in sketches.merged(df, ["k"], {
        "n": sketches.counted(), "even": sketches.counted(F.col("v") % 2 == 0), "low": (F.min("v"), F.min),
        "items": sketches.frequent_items(F.col("h")), "sketch": sketches.quantile_sketch(F.col("v")),
    }).select("k", "n", "even", "low", sketches.most_frequent("items", 2).alias("items"),
              sketches.sketch_quantiles("sketch", F.expr("array(0.0D, 0.5D, 1.0D)")).alias("q")).collect()}
    assert sum(r["n"] for r in row.values()) == 50_000 and [row[k]["low"] for k in range(3)] == [0, 1, 2]
    for r in row.values():
        assert r["items"][0]["item"] == 7 and r["items"][0]["count"] >= r["even"]
        assert abs(r["q"][1] - 25_000) <= 50_000 * sketches.KLL_ERROR


def test_distinct_values_settled_by_ranges(spark, monkeypatch):
    """Far from a limit a sketch decides; at it, above it by one and below it by one, values are counted."""
    n = 20_000
    df = spark.range(0, n, 1, 16).selectExpr(
        "concat('u', id) AS unique", "concat('h', id % 9000) AS half", f"concat('e', least(id, {n * 95 // 100} - 1)) AS exact",
        f"concat('b', least(id, {n * 95 // 100} - 2)) AS below", "CAST(NULL AS STRING) AS empty")
    counted = []
    original = profile.distinct_counts
    monkeypatch.setattr(profile, "distinct_counts", lambda df, columns: counted.extend(columns) or original(df, columns))
    stats = profile.collect_stats(df)
    profile.settle_distinct(df, stats, df.columns, lambda s: [0.95 * s.filled])
    assert sorted(counted) == ["below", "empty", "exact"]
    assert [stats[c].uniqueness >= 0.95 for c in df.columns] == [True, False, True, False, False]
    assert isinstance(stats["unique"].distinct, profile.DistinctRange) and stats["unique"].distinct.holds(n) and stats["half"].distinct.holds(9000)
    assert stats["exact"].distinct == n * 95 // 100 and stats["below"].distinct == n * 95 // 100 - 1
    # Another limit asks again only where the range does not tell.
    counted.clear()
    profile.settle_distinct(df, stats, ["unique", "half"], lambda s: [0.3 * s.rows, 0.45 * s.rows])
    assert counted == ["half"] and stats["half"].distinct == 9000


def test_ranges_hold_the_counts(spark):
    for n in (1, 50, 3000, 200_000):
        df = spark.range(0, n, 1, 8).selectExpr("id AS a", "cast(id % 7 AS double) AS b")
        ranges = profile.distinct_ranges(df, ["a", "b"])
        assert ranges["a"].holds(n) and ranges["b"].holds(min(n, 7)) and ranges["a"].high <= n
