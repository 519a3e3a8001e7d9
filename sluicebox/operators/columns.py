"""Column names, sparse columns, shape and previews."""
from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from sluicebox import fixed_values as fv
from sluicebox.operators.profile import ROW_ORDER, collect_stats, column, data_columns


def clean_name(name: str) -> str:
    """Lower case, with every run of characters other than letters and digits as one ``_``."""
    return re.sub(r"[\W_]+", "_", name.strip().lower()).strip("_")


def header_names(header: Iterable[str | None]) -> list[str]:
    """Names for a raw header line: blanks are numbered, repeats get ``.1``, ``.2``."""
    seen: dict[str, int] = {}
    out = []
    for position, name in enumerate(header):
        name = name if name else f"Unnamed: {position}"
        repeats = seen.get(name, 0)
        seen[name] = repeats + 1
        out.append(f"{name}.{repeats}" if repeats else name)
    return out


def clean_names(names: Iterable[str]) -> list[str]:
    """`clean_name` for each, with ``_2``, ``_3`` where two names become equal."""
    out: list[str] = []
    for position, name in enumerate(names):
        base = clean_name(name) or f"unnamed_{position}"
        candidate, number = base, 2
        while candidate in out:
            candidate, number = f"{base}_{number}", number + 1
        out.append(candidate)
    return out


def rename_clean(df: DataFrame) -> DataFrame:
    kept = data_columns(df)
    new = dict(zip(kept, clean_names(kept)))
    return df.toDF(*[new.get(c, c) for c in df.columns])


def drop_empty_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Without the columns that hold no value at all."""
    empty = [c for c, s in collect_stats(df).items() if s.filled == 0]
    return df.drop(*[column(c) for c in empty]), empty


def drop_sparse_columns(
    df: DataFrame, threshold: float = fv.SPARSE_LIMIT, null_ratios: dict[str, float] | None = None
) -> tuple[DataFrame, list[str]]:
    """Without the columns whose share of NULLs is above the threshold."""
    if null_ratios is None:
        null_ratios = {c: s.null_ratio for c, s in collect_stats(df).items()}
    sparse = [c for c in data_columns(df) if null_ratios.get(c, 0.0) > threshold]
    return df.drop(*[column(c) for c in sparse]), sparse


def shape(df: DataFrame) -> tuple[tuple[int, int], int, int]:
    rows, width = df.count(), len(data_columns(df))
    return (rows, width), rows, width


def preview(df: DataFrame, n: int = 10, order_by=ROW_ORDER) -> DataFrame:
    """The first rows in table order (a top-n, not a full sort)."""
    if isinstance(order_by, str) and order_by not in df.columns:
        return df.limit(n)
    order_by = [order_by] if isinstance(order_by, (str, F.Column)) else order_by
    return df.orderBy(*order_by).limit(n)
