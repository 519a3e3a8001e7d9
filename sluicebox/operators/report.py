"""Reporting aggregates: missing values, headline numbers, column descriptions, bin histograms."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sluicebox.operators.profile import (
    ColumnStats, cell_number, collect_stats, column, data_columns, distinct_counts, gap_stats, kinds, measure, modes, stack,
)
from sluicebox.operators.quantiles import exact_quantiles
from sluicebox.operators.validate import is_structural


def missing_counts(df: DataFrame, stats: dict[str, ColumnStats] | None = None) -> DataFrame:
    """NULLs per column that has any, structural columns aside; zeros for all if none has."""
    stats = gap_stats(df) if stats is None else stats
    some = [(c, s.nulls) for c, s in stats.items() if s.nulls and not is_structural(s)]
    rows = some or [(c, 0) for c in stats]
    return df.sparkSession.createDataFrame(rows, "column string, missing bigint")


def null_percent(df: DataFrame) -> DataFrame:
    """Share of NULLs per column, in percent."""
    share = (F.col("rows") - F.col("filled")) * F.lit(100.0) / F.col("rows")
    return measure(df).select("column", (F.col("rows") - F.col("filled")).alias("nulls"), share.alias("null_percent"))


def headline(df: DataFrame) -> DataFrame:
    """One row: number of rows, of columns, and of missing cells."""
    return measure(df).agg(
        F.max("rows").alias("rows"),
        F.count(F.lit(1)).alias("columns"),
        F.sum(F.col("rows") - F.col("filled")).alias("missing"),
    )


def year_end_notice(df: DataFrame) -> list[str]:
    """Year columns ending in ``_end`` that have gaps, which is expected of them."""
    wanted = [c for c in data_columns(df) if c.startswith("year") and c.endswith("_end")]
    return [c for c, s in collect_stats(df, wanted).items() if s.nulls]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top, freq for text; mean, std, min, quartiles, max for numbers.

    Times are described by count and by numbers in epoch seconds.
    """
    columns = data_columns(df) if columns is None else list(columns)
    kind = kinds(df)
    words = [c for c in columns if kind[c] in ("text", "flag", "other")]
    numbers = [c for c in columns if c not in words]
    spark = df.sparkSession
    epoch = df.select(*[
        (column(c).cast("timestamp").cast("double") if kind[c] == "time" else cell_number(c, kind[c])).alias(c)
        for c in numbers
    ]) if numbers else None
    out = None
    if words:
        filled, distinct = collect_stats(df, words), distinct_counts(df, words)
        rows = [
            (c, filled[c].filled, distinct[c], r["txt"] if r["whole"] is None else str(bool(r["whole"])).lower(), r["n"])
            for c, r in modes(df, words).items()
        ]
        out = spark.createDataFrame(rows, "column string, count bigint, unique bigint, top string, freq bigint").select(
            "*", *[F.lit(None).cast("double").alias(s) for s in ("mean", "std", "min", "q25", "q50", "q75", "max")])
    if numbers:
        quartiles = exact_quantiles(epoch, numbers, (0.25, 0.5, 0.75))
        rows = [
            (F.lit(c), column(c), *[F.lit(q).cast("double") for q in quartiles[c]]) for c in numbers
        ]
        long = stack(epoch, rows, ("column", "value", "q25", "q50", "q75"))
        part = long.groupBy("column", "q25", "q50", "q75").agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max"),
        ).select(
            "column", "count", F.lit(None).cast("bigint").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("bigint").alias("freq"), "mean", "std", "min", "q25", "q50", "q75", "max",
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("nothing to describe")
    return out


def bin_histogram(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per bin of every ``*_bin`` column (rows without a bin aside), in one grouping."""
    if columns is None:
        columns = [c for c in df.columns if c.endswith("_bin")]
    if not columns:
        raise ValueError("no bin columns")
    return (
        stack(df, [(F.lit(c), column(c).cast("string")) for c in columns], ("column", "bin"))
        .where("bin IS NOT NULL").groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    )


def sorted_histogram(histogram: DataFrame) -> DataFrame:
    """A `bin_histogram` from the lowest to the highest bin (one row per bin, so a small sort)."""
    low = F.regexp_extract("bin", r"^\(([^,]+),", 1).cast("double")
    return histogram.orderBy("column", low)
