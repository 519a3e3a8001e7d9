"""What a pass over a large table may cost: tests once for equal cells, rules once for a cell, one pass to tell rows apart."""
import pytest
from pyspark.sql import functions as F

from sluicebox import fixed_values as fv
from sluicebox.functions import parsing, text
from sluicebox.operators import dedup, profile, quantiles, standardize
from sluicebox.operators.distinct_cells import distinct_cells
from sluicebox.plans.workspace import HUGE_METHOD, OPEN_FILES, Workspace
from sluicebox.sources import csv
from sluicebox.sources.csv import clean_text_columns, load_frame

ODD = [
    None, "", " ", "a", "Ä", "é1234567", "ǆ", "ſ", "İ", "ß", "12345678", "abc-1234", "ABCDEFG1\n", "12ab cd34", "a1" * 5 + "é", "x\ny1234567",
    "2020-01-02", " 2020-1-2 ", "2020-01-02\n", "1/2/2020", "1 Jan 2020", "January 1, 2020", "2020-01-02T10:00:00.5", "--------", "1//2/2020",
    "100373/4", "\x1f2020-1-2", "  two  blanks [a] †", "â€¡ ﬁne ［x］ Ã©", "5K[a]", "[a]", "5K\n[a]", " $1,200.50 ", "3.5m,", "-", "1.2.3", "1e5",
    "9" * 400, "9" * 299, "19951996", "1995–1996", "1995−96", "now 1999, 2005 or 2020", "no year", " $5 ", "\x1c7K\x1c",
]


def test_equal_cells_are_looked_at_once(spark):
    df = spark.range(120_000, numPartitions=1).select(
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), F.col("id") % 4)).alias("few"), F.concat(F.lit("line "), F.col("id")).alias("all"))
    cells = distinct_cells(df, {0: "few", 1: "all"})
    found = {r["position"]: r for r in cells.groupBy("position").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect()}
    assert found[0]["n"] == found[1]["n"] == 120_000 and found[0]["rows"] < 50 and found[1]["rows"] == 120_000
    counts = {r["txt"]: r["n"] for r in cells.where("position = 0").groupBy("txt").agg(F.sum("n").alias("n")).collect()}
    assert counts == {None: 30_000, "v1": 30_000, "v2": 30_000, "v3": 30_000}
    stats = profile.collect_stats(df, groups=profile.ALL_GROUPS)
    assert (stats["few"].rows, stats["few"].filled, stats["few"].counts["letters"]) == (120_000, 90_000, 90_000)
    assert "MapInArrow" in profile.measure(df, groups=("dirt",))._jdf.queryExecution().executedPlan().toString()


def test_cheap_looks_tell_the_same(one):
    shapes = "|".join(shape.strip("^$") for _, shape, _ in fv.DATE_FORMATS)
    assert one(profile._has_letter, ODD) == one(lambda c: c.rlike(fv.HAS_LETTER), ODD)
    assert one(profile._date_like, ODD) == one(lambda c: (F.octet_length(c) >= 8) & c.rlike(f"^(?:{shapes})$"), ODD)
    assert one(text.strip_edges, ODD) == one(text.strip, ODD)
    words = [*fv.MISSING_WORDS, "x", None]
    assert one(lambda c: text.is_one_of(c, fv.MISSING_WORDS), words) == [True] * len(fv.MISSING_WORDS) + [False, None]


def test_rules_in_steps_do_what_they_do_at_once(spark, one):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(ODD)], "i int, c string").coalesce(1)
    cleaned = [r["c"] for r in clean_text_columns(df).orderBy("i").collect()]
    kept = lambda c: F.regexp_replace(F.regexp_replace(text.nfkc(text.fix_mojibake(c)), r"\[[^\]]*\]|[^\x20-\x7E]|\*", ""), " {2,}", " ")
    assert cleaned == one(lambda c: F.trim(kept(c)), ODD)
    assert cleaned == one(lambda c: text.clean_text(c, mend=True), ODD)
    for chosen, rule in ((standardize.MONEY, parsing.clean_numeric_or_keep), (standardize.YEAR, lambda c: parsing.year_bounds(c)[0])):
        stats = profile.collect_stats(df, groups=standardize.PROFILE_GROUPS, parse_dates=False)
        with pytest.MonkeyPatch.context() as patched:
            patched.setattr(standardize, "profile_routes", lambda df, stats=None: ({"i": standardize.KEEP, "c": chosen}, stats))
            done = standardize.standardize(df, stats).df
        assert [r["c"] for r in done.orderBy("i").collect()] == one(rule, ODD)


def test_columns_of_few_texts_are_cleaned_once_for_each(spark, monkeypatch):
    df = spark.range(4000, numPartitions=2).select(
        F.element_at(F.array(*[F.lit(c) for c in ODD]), (F.col("id") % len(ODD) + 1).cast("int")).alias("Odd one"),
        F.concat(F.lit("†"), F.col("id"), F.lit(" [x]")).alias("all"), F.col("id"), F.lit("7").alias("whole"))
    plain, seen = load_frame(df), []
    made = csv._cleaned_words
    monkeypatch.setattr(csv, "_cleaned_words", lambda *given: seen.append(made(*given)) or seen[-1])
    known = load_frame(df, workspace=Workspace(spark))
    assert list(seen[0]) == ["odd_one"] and dict(known.dtypes)["whole"] == "bigint"
    assert known.dtypes == plain.dtypes and known.exceptAll(plain).count() == plain.exceptAll(known).count() == 0
    # A text that the table of words lacks is cleaned all the same.
    fewer = {c: words.limit(3) for c, words in seen[0].items()}
    named = df.toDF("odd_one", "all", "id", "whole")
    some, none = clean_text_columns(named, words=fewer), clean_text_columns(named)
    assert some.exceptAll(none).count() == none.exceptAll(some).count() == 0


@pytest.mark.parametrize("keep", ["first", "last", False])
def test_rows_are_told_apart_in_one_pass(spark, keep):
    df = spark.range(2000).select("id", F.when(F.col("id") % 1900 > 0, F.col("id") % 1900).alias("k"))
    done = dedup.remove_duplicates(df, ["k"], keep=keep, order_by="id")
    expected = {"first": set(range(1900)), "last": set(range(100, 2000)), False: set(range(100, 1900))}[keep]
    assert {r["id"] for r in done.df.collect()} == expected
    # The rows left as they are come from a written table: the join that tells them apart ran once.
    assert "Join" not in done.df._jdf.queryExecution().executedPlan().toString()


def test_settings_come_back_after_a_write(spark):
    before = [spark.conf.get(n) for n in (HUGE_METHOD, OPEN_FILES)]
    written = Workspace(spark).stage(spark.range(10).withColumn("odd", F.col("id") % 2 == 1), "t", by="odd")
    assert written.where("odd").count() == 5 and [spark.conf.get(n) for n in (HUGE_METHOD, OPEN_FILES)] == before


def test_ends_of_an_interval_are_counted_without_another_form(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("double").alias("v"))
    assert quantiles._places(df, [("v", 2.0, 5.0)], {"v": "fraction"}) == [(200, 100, 200, 100)]
