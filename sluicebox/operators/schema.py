"""Logical types: detect them from values, and cast to them."""
from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluicebox import fixed_values as fv
from sluicebox.functions.parsing import parse_boolean, parse_date, parse_number
from sluicebox.operators.profile import (
    ROW_ORDER, ColumnStats, cell_text, collect_stats, column, date_counts, kinds, settle_distinct,
)

log = logging.getLogger(__name__)

BOOLEAN, INTEGER, FLOAT, DATETIME, CATEGORY, TEXT = (
    "boolean", "integer", "float", "datetime", "category", "text",
)
DETECT_GROUPS = ("numbers", "flags", "dates")


def type_before_distinct(stats: ColumnStats) -> str | None:
    """The logical type, or ``None`` where only the distinct count can tell category from text."""
    if not stats.filled:
        return TEXT
    if stats.counts["boolean_word"] == stats.filled:
        return BOOLEAN
    if stats.kind == "time":
        return DATETIME
    if stats.of_filled("parsed") >= fv.TYPE_THRESHOLD:
        whole = stats.counts["whole"] / stats.counts["parsed"]
        return INTEGER if whole >= fv.INTEGRAL_THRESHOLD else FLOAT
    if stats.best_date_format()[1] / stats.filled >= fv.TYPE_THRESHOLD:
        return DATETIME
    return None


def detected_type(stats: ColumnStats) -> str:
    early = type_before_distinct(stats)
    if early is not None:
        return early
    return CATEGORY if stats.uniqueness <= fv.CATEGORY_LIMIT else TEXT


def profile_types(df: DataFrame, stats: dict[str, ColumnStats] | None = None) -> dict[str, ColumnStats]:
    """The counts type detection needs; dates and distinct values only where they can matter."""
    if stats is None:
        stats = collect_stats(df, groups=DETECT_GROUPS, parse_dates=False)
    open_ = {c: s for c, s in stats.items() if type_before_distinct(s) is None}
    dates = [c for c, s in open_.items() if s.of_filled("date_like") >= fv.TYPE_THRESHOLD]
    for name, counts in date_counts(df, dates).items():
        stats[name] = stats[name].changed(counts=counts)
    undecided = [c for c in open_ if type_before_distinct(stats[c]) is None]
    stats.update({c: stats[c].changed(distinct=None) for c in undecided})
    settle_distinct(df, stats, undecided, lambda s: [fv.CATEGORY_LIMIT * s.filled])
    return stats


def detect_schema(df: DataFrame, stats: dict[str, ColumnStats] | None = None) -> dict[str, str]:
    """Column name to logical type, in column order."""
    stats = profile_types(df) if stats is None else stats
    return {c: detected_type(s) for c, s in stats.items()}


@dataclass
class Typed:
    df: DataFrame
    stats: dict[str, ColumnStats] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)


def _whole_number(name: str, kind: str) -> Column:
    """Text digits go straight to 64 bits, so large ids keep their last digits."""
    if kind == "text":
        cell = column(name)
        digits = F.when(cell.rlike(fv.WHOLE_NUMBER), cell.try_cast("bigint"))
        return F.coalesce(digits, parse_number(cell).try_cast("bigint"))
    return column(name).try_cast("bigint")


def _number(name: str, kind: str, exact: bool = False) -> Column:
    """``exact`` columns, decimals, keep their type: a double would lose digits."""
    if exact:
        return column(name)
    return parse_number(column(name)) if kind == "text" else column(name).cast("double")


def apply_schema(
    df: DataFrame,
    schema: dict[str, str],
    stats: dict[str, ColumnStats] | None = None,
    strict_boolean: bool = False,
) -> Typed:
    """Cast each column to its logical type; cells that do not fit become NULL.

    Integers that are not all whole, finite and within 64 bits become doubles.
    With ``strict_boolean`` yes/no text stays text and is reported, as is any
    column that cannot be cast at all.
    """
    stats = collect_stats(df, groups=DETECT_GROUPS) if stats is None else stats
    kind = kinds(df)
    scales = {f.name: f.dataType.scale for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    out, warnings = [], []
    filled = {c: s.filled for c, s in stats.items()}

    for name in df.columns:
        cell = column(name)
        if name == ROW_ORDER or name not in schema:
            out.append(cell)
            continue
        s, k, logical = stats[name], kind[name], schema[name]
        kept = s.filled
        if logical == INTEGER and k != "time":
            bounds = [abs(v) for v in (s.low, s.high) if v is not None]
            safe = (
                s.counts["whole"] == s.counts["parsed"]
                and s.counts["infinite"] == 0
                and all(b < 2.0 ** 63 for b in bounds)
            )
            cast = _whole_number(name, k) if safe and scales.get(name, 0) == 0 else _number(name, k, name in scales)
            kept = s.counts["parsed"]
        elif logical == FLOAT and k != "time":
            cast, kept = _number(name, k, name in scales), s.counts["parsed"]
        elif logical == BOOLEAN:
            if k == "text" and strict_boolean:
                warnings.append(f"{name}: text is not cast to boolean")
                cast = cell
            else:
                cast = cell if k == "flag" else parse_boolean(cell_text(name, k))
                kept = s.counts["boolean_word"]
        elif logical == DATETIME:
            if k == "text":
                date_format, kept = s.best_date_format()
                cast = parse_date(cell, date_format) if date_format else F.lit(None).cast("timestamp")
            else:
                cast = cell.cast("timestamp") if k != "time" else cell
        elif logical == CATEGORY:
            out.append(cell.cast("string").alias(name, metadata={"logical": CATEGORY}))
            continue
        elif logical == TEXT:
            cast = cell if k == "other" else cell.cast("string")
        else:
            warnings.append(f"{name}: unknown or unfitting type {logical}")
            cast = cell
        out.append(cast.alias(name))
        filled[name] = kept
    for message in warnings:
        log.warning(message)
    typed = df.select(*out)
    after = {}
    for name, k in kinds(typed).items():
        if name in stats:
            s = stats[name]
            counts = {} if k == "text" or "id_value" not in s.counts else {"id_value": 0}
            distinct = s.distinct if k == kind[name] and filled[name] == s.filled else None
            after[name] = s.changed(kind=k, filled=filled[name], distinct=distinct, counts=counts)
    return Typed(typed, after, warnings)
