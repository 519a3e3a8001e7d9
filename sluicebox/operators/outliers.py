"""Outliers by the interquartile range: bounds, box-plot numbers, flags, clipping."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox import fixed_values as fv
from sluicebox.functions.parsing import parse_number
from sluicebox.operators.profile import (
    ColumnStats, cell_number, collect_stats, column, kinds, stack,
)
from sluicebox.operators.quantiles import exact_quantiles


def _year_name(name: str) -> bool:
    return "year" in name.lower() or "yr" in name.lower()


def eligible_by_schema(df: DataFrame, schema: dict[str, str]) -> list[str]:
    """Present float and integer columns whose name does not speak of years."""
    return [c for c, t in schema.items() if t in ("float", "integer") and not _year_name(c) and c in df.columns]


def eligible_by_values(df: DataFrame, stats: dict[str, ColumnStats] | None = None) -> list[str]:
    """Numeric columns with more than one value, and text of which at least 0.6 of all rows are numbers."""
    stats = collect_stats(df, groups=("numbers",)) if stats is None else stats
    out = []
    for name, s in stats.items():
        if _year_name(name):
            continue
        if s.kind in ("whole", "fraction"):
            spread = s.low is not None and (s.low != s.high or s.counts["infinite"] > 0)
            if spread or (s.low is None and s.counts["infinite"] > 0):
                out.append(name)
        elif s.kind == "text" and s.rows and s.of_rows("parsed") >= fv.NUMERIC_LIKE_THRESHOLD:
            out.append(name)
    return out


def as_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only these columns, each as double."""
    kind = kinds(df)
    return df.select(*[
        (parse_number(column(c)) if kind[c] == "text" else cell_number(c, kind[c])).alias(c) for c in columns
    ])


def quartile_bounds(
    df: DataFrame, columns: Sequence[str], stats: dict[str, ColumnStats] | None = None
) -> dict[str, tuple]:
    """Per column: lowest, Q1, median, Q3, highest value and the two clip bounds.

    The clip bounds are ``None`` where the quartiles coincide or are missing.
    ``stats`` with parsed counts spare a counting pass.
    """
    out = {}
    filled = {c: stats[c].counts["parsed"] for c in columns} if stats else None
    found = exact_quantiles(as_numbers(df, columns), columns, (0.0, 0.25, 0.5, 0.75, 1.0), filled)
    for name, (low, q1, median, q3, high) in found.items():
        lower = upper = None
        if q1 is not None and q3 - q1 > 0:
            lower = q1 - fv.IQR_FACTOR * (q3 - q1)
            upper = q3 + fv.IQR_FACTOR * (q3 - q1)
        out[name] = (low, q1, median, q3, high, lower, upper)
    return out


def _number(df: DataFrame, name: str) -> Column:
    kind = kinds(df)[name]
    return parse_number(column(name)) if kind == "text" else cell_number(name, kind)


def clip_outliers(df: DataFrame, columns: Sequence[str], bounds: dict[str, tuple] | None = None) -> DataFrame:
    """Values beyond the bounds moved onto them; columns without bounds stay."""
    bounds = quartile_bounds(df, columns) if bounds is None else bounds
    out = []
    for name in df.columns:
        lower, upper = bounds[name][5:] if name in bounds else (None, None)
        if lower is None:
            out.append(column(name))
            continue
        value = _number(df, name)
        clipped = F.greatest(F.least(value, F.lit(upper)), F.lit(lower))
        out.append(F.when(value.isNotNull(), clipped).alias(name))
    return df.select(*out)


def outlier_flags(df: DataFrame, columns: Sequence[str], bounds: dict[str, tuple] | None = None) -> DataFrame:
    """The table with a boolean ``<column>_outlier`` for each column."""
    bounds = quartile_bounds(df, columns) if bounds is None else bounds
    flags = []
    for name in columns:
        lower, upper = bounds[name][5:]
        value = _number(df, name)
        flag = F.lit(False) if lower is None else F.coalesce(~value.between(lower, upper), F.lit(False))
        flags.append(flag.alias(f"{name}_outlier"))
    return df.select("*", *flags)


def boxplot_stats(df: DataFrame, columns: Sequence[str], bounds: dict[str, tuple] | None = None) -> DataFrame:
    """One row per column: quartiles, bounds, whisker ends after clipping, number of outliers."""
    bounds = quartile_bounds(df, columns) if bounds is None else bounds
    rows = []
    for name in columns:
        low, q1, median, q3, high, lower, upper = bounds[name]
        fixed = [F.lit(v).cast("double") for v in (q1, median, q3, lower, upper)]
        rows.append((F.lit(name), _number(df, name), *fixed))
    names = ("column", "value", "q1", "median", "q3", "lower", "upper")
    long = stack(df, rows, names)
    clipped = F.coalesce(
        F.greatest(F.least(F.col("value"), F.col("upper")), F.col("lower")), F.col("value")
    )
    clipped = F.when(F.col("value").isNotNull(), clipped)
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return long.groupBy("column", "q1", "median", "q3", "lower", "upper").agg(
        F.count("value").alias("filled"),
        F.min(clipped).alias("whisker_low"),
        F.max(clipped).alias("whisker_high"),
        F.count_if(outside).alias("outliers"),
    )
