"""Transform plans: suggest one from a profile, and apply one in a single projection."""
from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluicebox import fixed_values as fv
from sluicebox.functions.parsing import is_whole, parse_number, split_year
from sluicebox.functions.text import multi_values, normalize_delimiters, split_multi_values, strip
from sluicebox.operators.profile import (
    cell_number, collect_stats, column, kinds, settle_distinct,
)
from sluicebox.operators.quantiles import exact_quantiles

log = logging.getLogger(__name__)


def suggest_plan(df: DataFrame, dataset: str, enable_all: bool = False) -> dict:
    """A plan the user may edit: per column the suggested steps, and which are switched on.

    Steps that are not on by default are switched off unless ``enable_all``.
    """
    stats = collect_stats(df, groups=("marks",))
    kind = kinds(df)
    numeric = [c for c, s in stats.items() if kind[c] in ("whole", "fraction", "flag") and s.filled]
    rows = max((s.rows for s in stats.values()), default=0)
    settle_distinct(df, stats, numeric, lambda s: [fv.BIN_UNIQUE_LIMIT * max(rows, 1)])
    columns = {}
    for name, s in stats.items():
        steps: dict[str, dict] = {}

        def suggest(step: str, reason: str, default: bool, **more) -> None:
            steps[step] = {**more, "reason": fv.REASONS[reason], "default": default}

        if kind[name] == "text":
            suggest("lowercase", "lowercase", True)
            suggest("strip", "strip", True)
            if s.counts["delimiter"]:
                suggest("normalize_delimiters", "normalize_delimiters", True)
                suggest("split_multi_values", "split_multi_values", False)
            if "year" in name.lower() and s.counts["dash"]:
                suggest("split_year", "split_year", True)
        elif kind[name] in ("whole", "fraction", "flag"):
            if name.lower().startswith("year"):
                suggest("cast", "cast_year", True, type="int")
            else:
                suggest("cast", "cast", True, type="float")
            if s.least_distinct / max(rows, 1) > fv.BIN_UNIQUE_LIMIT:
                suggest("bins", "bins", False, type="auto")
        if steps:
            enabled = {step: enable_all or spec["default"] for step, spec in steps.items()}
            columns[name] = {"suggested": steps, "enabled": enabled}
    return {"dataset": dataset, "columns": columns}


def cast_number(value: Column, kind: str, target: str = "float") -> Column:
    number = parse_number(value) if kind == "text" else value.cast("double")
    if target == "int":
        if kind == "whole":
            return value.cast("bigint")
        return F.when(is_whole(number), number.try_cast("bigint"))
    return number


# --- quantile bins

def bin_edges(quantiles: Sequence[float | None]) -> list[float]:
    """Strictly rising bin edges; fewer than two mean that there is nothing to bin."""
    return sorted({q for q in quantiles if q is not None})


def _rounded(edge: float, digits: int) -> float:
    """An edge to so many digits after the point, or significant ones where it is below one."""
    if edge == 0 or not math.isfinite(edge):
        return edge
    if abs(edge) < 1:
        digits += -int(math.floor(math.log10(abs(edge)))) - 1
    return round(edge, digits)


def bin_labels(edges: Sequence[float]) -> list[str]:
    """``(low, high]`` per bin, with as few digits as keep the edges apart, at least three."""
    digits = next(d for d in range(3, 20) if d == 19 or len({_rounded(e, d) for e in edges}) == len(edges))
    shown = [_rounded(e, digits) for e in edges]
    # A step of the last digit below the lowest edge, without the noise of the subtraction.
    shown[0] = round(shown[0] - 10 ** -digits, 12)
    return [f"({low}, {high}]" for low, high in zip(shown, shown[1:])]


def assign_bin(value: Column, edges: Sequence[float], values: Sequence) -> Column:
    """The entry of ``values`` for the right-closed bin the value falls into; the lowest edge belongs to the first."""
    out = None
    for upper, result in zip(edges[1:], values):
        test = value <= F.lit(upper)
        out = F.when(test, F.lit(result)) if out is None else out.when(test, F.lit(result))
    return F.when(value >= F.lit(edges[0]), out)


def quantile_bins(df: DataFrame, columns: Sequence[str], count: int = fv.BIN_COUNT) -> tuple[DataFrame, dict[str, list[float]]]:
    """``<column>_bin`` (label) and ``<column>_bin_index`` (from 0) per column, and the edges."""
    kind = kinds(df)
    shares = [i / count for i in range(count + 1)]
    edges = {c: bin_edges(q) for c, q in exact_quantiles(df, columns, shares).items()}
    added = []
    for name in columns:
        if len(edges[name]) < 2:
            continue
        value = cell_number(name, kind[name])
        labels = bin_labels(edges[name])
        added.append(assign_bin(value, edges[name], labels).alias(f"{name}_bin"))
        added.append(assign_bin(value, edges[name], range(len(labels))).alias(f"{name}_bin_index"))
    return df.select("*", *added), edges


# --- applying a plan

@dataclass
class Transformed:
    df: DataFrame
    report: dict = field(default_factory=dict)
    bins: dict[str, list[float]] = field(default_factory=dict)


def apply_plan(df: DataFrame, plan: dict | None, dataset: str | None = None) -> Transformed:
    """The enabled steps of every column, then the table-wide filter and grouping.

    Steps run in a fixed order per column: cast, lower case, strip, delimiters,
    multi-values, year split, bins.  Multi-values stay text, or become a list of
    values where the plan says ``"as": "list"`` of them.  Everything is one projection; bins need one
    pass over the binned columns before it.
    """
    if not plan:
        log.warning("no transform plan; the table stays as it is")
        return Transformed(df)
    report = {
        "dataset": dataset or plan.get("dataset"),
        "applied_at": datetime.now().isoformat(),
        "column_transformations": {},
        "dataset_operations": {},
        "generated_columns": [],
    }
    kind = kinds(df)
    current = {name: column(name) for name in df.columns}
    added: dict[str, Column] = {}
    to_bin: list[str] = []
    for name, spec in plan.get("columns", {}).items():
        if name not in current:
            continue
        enabled = spec.get("enabled", {})
        suggested = spec.get("suggested", {})
        done, k, value = [], kind[name], current[name]
        if enabled.get("cast"):
            target = suggested.get("cast", {}).get("type", "float")
            if k == "flag":
                value, k = value.cast("int"), "whole"
            value = cast_number(value, k, target)
            k = "whole" if target == "int" else "fraction"
            done.append("cast_to_numeric")
        text_steps = [s for s in ("lowercase", "strip", "normalize_delimiters", "split_multi_values", "split_year") if enabled.get(s)]
        if text_steps and k != "text":
            value = value.cast("string")
            k = "text"
        for step, rewrite in (("lowercase", F.lower), ("strip", strip), ("normalize_delimiters", normalize_delimiters)):
            if step in text_steps:
                value = rewrite(value)
                done.append(step)
        as_list = suggested.get("split_multi_values", {}).get("as") == "list"
        if "split_multi_values" in text_steps:
            value = F.filter(multi_values(F.lower(strip(value))), lambda v: v != "") if as_list else split_multi_values(value)
            if as_list:
                k = "other"
                done.append("split_to_list")
        if "split_year" in text_steps and k == "text":
            added[f"{name}_start"], added[f"{name}_end"] = split_year(value)
            done.append("split_year")
        current[name] = value.alias(name)
        if enabled.get("bins") is True and k in ("whole", "fraction"):
            to_bin.append(name)
            done.append("bins_created")
        if done:
            report["column_transformations"][name] = done
    added_names = list(added)
    out = df.select(
        *[current[c] for c in df.columns if c not in added],
        *[value.alias(c) for c, value in added.items()],
    )
    bins: dict[str, list[float]] = {}
    if to_bin:
        out, bins = quantile_bins(out, to_bin)
        out = out.drop(*[f"{c}_bin_index" for c in to_bin])
        for name in to_bin:
            if len(bins[name]) < 2:
                log.warning("%s has too few values to bin", name)
                report["column_transformations"][name].remove("bins_created")
                if not report["column_transformations"][name]:
                    del report["column_transformations"][name]
    generated = [f"{c}_bin" for c in to_bin if len(bins[c]) >= 2]
    report["generated_columns"] = added_names + generated
    operations = plan.get("dataset_ops") or {}
    if operations.get("filter"):
        out = filter_rows(out, operations["filter"])
        report["dataset_operations"]["filter"] = operations["filter"]
    grouping = operations.get("groupby") or {}
    if grouping.get("by"):
        out = group_rows(out, grouping["by"], grouping.get("agg") or {})
        report["dataset_operations"]["groupby"] = grouping
    return Transformed(out, report, bins)


def filter_rows(df: DataFrame, bounds: dict[str, dict]) -> DataFrame:
    """Rows within all bounds: ``{column: {">=": low, "<=": high}}``; a null bound is open.

    ``{column: {"contains": value}}`` keeps rows whose list has the value.
    """
    tests = {">=": Column.__ge__, "<=": Column.__le__, ">": Column.__gt__, "<": Column.__lt__, "contains": F.array_contains}
    for name, limits in bounds.items():
        if name not in df.columns:
            raise ValueError(f"cannot filter on the missing column {name}")
        for sign, limit in limits.items():
            if sign not in tests:
                raise ValueError(f"unknown comparison: {sign}")
            if sign == "contains" and not _is_list(df, name):
                raise ValueError(f"{name} is not a column of lists")
            if limit is not None:
                df = df.where(tests[sign](column(name), F.lit(limit)))
    return df


def _is_list(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


AGGREGATES = {
    "sum": F.sum, "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count,
    "nunique": F.count_distinct, "std": F.stddev_samp, "var": F.var_samp,
}


def group_rows(df: DataFrame, by: Sequence[str], aggregates: dict) -> DataFrame:
    """One row per group, with ``<column>_<function>`` for each aggregate; no keys means no change.

    A key that is a list stands for each of its distinct values; rows whose list is empty or missing are in no group.
    """
    if not by:
        return df
    for name in by:
        if _is_list(df, name):
            df = df.withColumn(name, F.explode(F.array_distinct(column(name))))
    chosen = []
    for name, functions in aggregates.items():
        for function in [functions] if isinstance(functions, str) else functions:
            if function not in AGGREGATES:
                raise ValueError(f"unknown aggregate: {function}")
            chosen.append(AGGREGATES[function](column(name)).alias(f"{name}_{function}"))
    grouped = df.groupBy(*[column(c) for c in by])
    if not chosen:
        return df.select(*[column(c) for c in by]).distinct()
    return grouped.agg(*chosen)
