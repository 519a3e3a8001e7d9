"""Missing cells: recognise, drop, fill, impute."""
from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox import fixed_values as fv
from sluicebox.functions.parsing import parse_number
from sluicebox.functions.text import null_missing
from sluicebox.operators.profile import (
    ColumnStats, collect_modes, collect_stats, column, data_columns, kinds,
)

log = logging.getLogger(__name__)


def normalize_missing(df: DataFrame, words=fv.MISSING_WORDS) -> DataFrame:
    """NULL in place of NaN and of cells that spell out a missing value."""
    kind = kinds(df)
    out = []
    for name in df.columns:
        if kind[name] == "text":
            out.append(null_missing(column(name), words).alias(name))
        elif kind[name] == "fraction" and dict(df.dtypes)[name] in ("float", "double"):
            out.append(F.when(~F.isnan(column(name)), column(name)).alias(name))
        else:
            out.append(column(name))
    return df.select(*out)


def drop_null_rows(df: DataFrame) -> DataFrame:
    return normalize_missing(df).na.drop("any", subset=data_columns(df))


def fill_constant(df: DataFrame, value) -> DataFrame:
    """Every missing cell as ``value``; a column whose type cannot hold it becomes text."""
    df = normalize_missing(df)
    if value is None:
        log.warning("a fill value is required; nothing was filled")
        return df
    kind, out = kinds(df), []
    is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
    for name in df.columns:
        cell, k = column(name), kind[name]
        if name not in data_columns(df) or k == "other":
            out.append(cell)
            continue
        if k == "fraction" and is_number:
            filled = F.coalesce(cell, F.lit(float(value)))
        elif k == "whole" and is_number:
            filled = F.coalesce(cell, F.lit(value))
        elif k == "flag" and isinstance(value, bool):
            filled = F.coalesce(cell, F.lit(value))
        else:
            filled = F.coalesce(cell.cast("string"), F.lit(str(value)))
        out.append(filled.alias(name))
    return df.select(*out)


def is_year_like(stats: ColumnStats, present: str = "parsed") -> bool:
    """Mostly values between the first and last plausible year."""
    base = stats.counts.get(present, 0)
    return base > 0 and stats.counts.get("in_years", 0) / base >= fv.YEAR_VALUE_THRESHOLD


@dataclass
class Imputed:
    df: DataFrame
    stats: dict[str, ColumnStats] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    coerced: list[str] = field(default_factory=list)
    filled: list[str] = field(default_factory=list)
    numeric: int = 0
    text: int = 0
    datetime: int = 0


def _numeric_like(stats: dict[str, ColumnStats]) -> list[str]:
    return [
        c for c, s in stats.items()
        if s.kind == "text" and s.rows and s.of_rows("parsed") >= fv.NUMERIC_LIKE_THRESHOLD
    ]


def keeps_digits(stats: ColumnStats) -> bool:
    """Text whose numbers are all whole and of 64 bits, some of them beyond what a double holds."""
    counts = stats.counts
    return counts.get("beyond_double", 0) > 0 and counts["fits"] == counts["parsed"]


def _as_numbers(df: DataFrame, columns: Sequence[str], stats: dict[str, ColumnStats]) -> DataFrame:
    """The text columns as doubles, or as 64-bit numbers where a double would change a digit."""
    def number(c):
        if keeps_digits(stats[c]):
            return F.when(column(c).rlike(fv.WHOLE_NUMBER), column(c).try_cast("bigint"))
        return parse_number(column(c))
    return df.select(*[number(c).alias(c) if c in columns else column(c) for c in df.columns])


def coerce_numeric_like(df: DataFrame, stats: dict[str, ColumnStats] | None = None) -> tuple[DataFrame, list[str]]:
    """Text columns of which at least 0.6 of all rows are numbers, as numbers."""
    stats = collect_stats(df, groups=("numbers",)) if stats is None else stats
    coerced = _numeric_like(stats)
    return _as_numbers(df, coerced, stats), coerced


def _after_fill(df: DataFrame, modes: dict[str, Column], stats: dict[str, ColumnStats], groups: Sequence[str]) -> dict[str, ColumnStats]:
    """Counts after each gap took its column's mode: the mode's own counts, once per gap."""
    if not modes:
        return stats
    one_row = df.sparkSession.range(1).select(*[value.alias(c) for c, value in modes.items()])
    out = dict(stats)
    for name, mode in collect_stats(one_row, groups=groups, parse_dates=False).items():
        s = stats[name]
        counts = {n: s.counts[n] + s.nulls * k for n, k in mode.counts.items() if n in s.counts}
        out[name] = s.changed(filled=s.rows, counts=counts)
    return out


def impute(
    df: DataFrame,
    also_numeric: tuple[str, ...] = (),
    stats: dict[str, ColumnStats] | None = None,
    groups: Sequence[str] = ("numbers",),
) -> Imputed:
    """Empty columns dropped, numeric-like text coerced, remaining gaps filled with the mode.

    Year columns keep their gaps.  ``also_numeric`` names text columns that came
    out of the amount cleaner: they become numbers whenever every filled cell is
    one.  ``stats`` of these groups, taken with missing words as NULL, spare a
    pass; the result carries the counts of the imputed table.
    """
    df = normalize_missing(df)
    stats = collect_stats(df, groups=groups, parse_dates=False) if stats is None else stats
    empty = [c for c, s in stats.items() if s.filled == 0]
    df = df.drop(*[column(c) for c in empty])
    stats = {c: s for c, s in stats.items() if s.filled}

    coerced = _numeric_like(stats)
    coerced += [
        c for c in also_numeric
        if c in stats and c not in coerced and stats[c].kind == "text"
        and stats[c].counts["parsed"] == stats[c].filled
    ]
    df = _as_numbers(df, coerced, stats)
    for name in coerced:
        s = stats[name]
        text_only = dict.fromkeys({"boolean_word", "date_like", "id_value", "fits", "beyond_double"} & set(s.counts), 0)
        stats[name] = s.changed(kind="whole" if keeps_digits(s) else "fraction", filled=s.counts["parsed"], counts=text_only)

    gaps = [
        c for c, s in stats.items()
        if s.nulls and s.kind != "other" and not (s.kind in ("whole", "fraction") and is_year_like(s))
    ]
    modes = collect_modes(df, gaps)
    out = [
        F.coalesce(column(c), modes[c]).alias(c) if c in modes else column(c) for c in df.columns
    ]
    held = [s.kind for s in stats.values()]
    return Imputed(
        df.select(*out), _after_fill(df, modes, stats, groups), empty, coerced, list(modes),
        numeric=held.count("whole") + held.count("fraction"),
        text=held.count("text"),
        datetime=held.count("time"),
    )


def handle_missing(df: DataFrame, strategy: str | None = "auto", fill_value=None) -> DataFrame:
    """``auto`` imputes, ``drop`` removes rows with gaps, ``fill`` writes one value; otherwise only marks gaps."""
    if strategy == "auto":
        return impute(df).df
    if strategy == "drop":
        return drop_null_rows(df)
    if strategy == "fill":
        return fill_constant(df, fill_value)
    log.warning("unknown strategy for missing values: %s", strategy)
    return normalize_missing(df)
