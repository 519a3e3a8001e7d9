"""Duplicate rows: which columns identify a row, how many repeat, and a guarded removal."""
from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox import fixed_values as fv
from sluicebox.operators.profile import (
    ROW_ORDER, ColumnStats, collect_stats, column, data_columns, kinds, settle_distinct,
)
from sluicebox.operators.standardize import add_uniqueness, is_id
from sluicebox.plans.workspace import Workspace

log = logging.getLogger(__name__)


@dataclass
class DedupStatus:
    executed: bool = False
    aborted: bool = False
    keys: list[str] | None = None
    removed: int = 0
    reason: str | None = None

    def as_dict(self) -> dict:
        return asdict(self)


@dataclass
class Deduplicated:
    df: DataFrame
    status: DedupStatus = field(default_factory=DedupStatus)
    #: Where rows were removed: the written rows with a key of their own, and the rows kept of the others.
    alone: DataFrame | None = None
    firsts: DataFrame | None = None


def choose_business_keys(schema: dict[str, str], stats: dict[str, ColumnStats], year_names: bool = True) -> list[str]:
    """Up to three columns: half-unique text, and columns with "year" in their name."""
    keys = []
    for name, logical in schema.items():
        s = stats.get(name)
        if s is None:
            continue
        half_unique = (
            logical in ("category", "text") and s.rows > 0 and s.distinct is not None
            and fv.KEY_UNIQUE_LOW < s.least_distinct / s.rows < fv.KEY_UNIQUE_HIGH
        )
        if half_unique or (year_names and "year" in name.lower()):
            keys.append(name)
    return keys[:fv.MAX_BUSINESS_KEYS]


def derive_keys(
    df: DataFrame,
    schema: dict[str, str],
    year_names: bool = True,
    stats: dict[str, ColumnStats] | None = None,
) -> list[str]:
    """All well-filled id columns; without any, up to three business keys.

    ``stats`` of the group "identity", with distinct counts where they are
    known, spare a pass over the table.
    """
    stats = collect_stats(df, groups=("identity",)) if stats is None else dict(stats)
    add_uniqueness(df, stats)
    ids = [
        c for c, s in stats.items()
        if is_id(s) and s.rows and s.filled / s.rows > fv.KEY_FILLED_LIMIT
    ]
    if ids:
        return ids
    open_ = [
        c for c, s in stats.items()
        if schema.get(c) in ("category", "text") and s.filled and s.filled / s.rows > fv.KEY_UNIQUE_LOW
    ]
    settle_distinct(df, stats, open_, lambda s: [fv.KEY_UNIQUE_LOW * s.rows, fv.KEY_UNIQUE_HIGH * s.rows])
    return choose_business_keys(schema, stats, year_names)


def _hashes(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """128 bits of hash of the keys as h1 and h2; NULL equals NULL, and -0.0 equals 0.0."""
    kind, parts = kinds(df), []
    for k in keys:
        value = column(k) + 0.0 if kind[k] == "fraction" and dict(df.dtypes)[k] in ("float", "double") else column(k)
        # A hash passes over NULLs, so where they stand is hashed, too.
        parts += [value, value.isNull()]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")]


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """h1, h2, n: how often each key occurs; two numbers travel per key and task, however wide the keys are."""
    return df.select(*_hashes(df, keys)).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: all rows, distinct keys (NULL equals NULL) and rows beyond the first of each key."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def keep_one(df: DataFrame, keys: list[str], keep: str | bool = "first", order_by: str | Column | None = None) -> DataFrame:
    """One row per key: the first or last in order, or with ``keep=False`` only rows without a twin.

    The kept row is an aggregate, so the copies of a hot key are reduced inside
    each task before the shuffle; a window would gather them in one task.
    """
    kind = kinds(df)
    last = keep == "last"
    if order_by is None and ROW_ORDER in df.columns:
        order_by = ROW_ORDER
    # Keys need not travel twice; fractions do, as grouping turns -0.0 into 0.0.
    carried = [c for c in df.columns if c not in keys or kind[c] == "fraction"] or df.columns
    row = F.struct(*[column(c) for c in carried])
    if order_by is None:
        # Without an order the smallest or largest row stays; it orders itself.
        best = F.max(row) if last else F.min(row)
    else:
        order = F.col(order_by) if isinstance(order_by, str) else order_by
        best = F.max_by(row, order) if last else F.min_by(row, order)
    aggregates = [best.alias("row")]
    if keep is False:
        aggregates.append(F.count(F.lit(1)).alias("n"))
    named = [column(k).alias(f"key_{i}") for i, k in enumerate(keys)]
    kept = df.groupBy(*named).agg(*aggregates)
    if keep is False:
        kept = kept.where("n = 1")
    return kept.select(*[
        F.col("row").getField(c).alias(c) if c in carried else F.col(f"key_{keys.index(c)}").alias(c)
        for c in df.columns
    ])


def keep_one_of_repeated(
    df: DataFrame, keys: list[str], repeated: DataFrame, keep: str | bool = "first", order_by: str | Column | None = None,
    workspace: Workspace | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`keep_one`, given the written table (h1, h2) of keys that repeat: rows with a key of their own, and those kept of others.

    Rows are tested against that table of two numbers per key: by a broadcast where it is below Spark's threshold in bytes,
    and else by one shuffle.  One pass writes both kinds of rows apart; only those whose key repeats are then reduced.
    """
    names = df.columns
    work = Workspace(df.sparkSession) if workspace is None else workspace
    hashed = df.select("*", *[h.alias(f"_key_{h_name}") for h, h_name in zip(_hashes(df, keys), ("h1", "h2"))])
    same = (F.col("_key_h1") == F.col("h1")) & (F.col("_key_h2") == F.col("h2"))
    told = hashed.join(repeated.select("h1", "h2"), same, "left").withColumn("_twin", F.col("h1").isNotNull())
    # Keys that repeat tell rows apart by their hashes; the others need not keep them.
    kept_hashes = [F.when(F.col("_twin"), F.col(h)).alias(h) for h in ("_key_h1", "_key_h2")]
    told = work.stage(told.select(*map(column, names), *kept_hashes, "_twin"), "told-apart", by="_twin")
    alone = told.where(~F.col("_twin")).select(*map(column, names))
    twins = told.where("_twin").select(*map(column, names), "_key_h1", "_key_h2")
    return alone, keep_one(twins, ["_key_h1", "_key_h2"], keep, order_by).select(*map(column, names))


def drop_repeated_rows(df: DataFrame, order_by: str | Column | None = None) -> DataFrame:
    """One copy of each fully equal row."""
    columns = data_columns(df)
    if columns == df.columns:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in columns]
    return df.groupBy(*[column(c) for c in columns]).agg(*[F.min(column(c)).alias(c) for c in rest])


def remove_duplicates(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    schema: dict[str, str] | None = None,
    keep: str | bool = "first",
    order_by: str | Column | None = None,
    limit: float = fv.REMOVAL_LIMIT,
    year_names: bool = True,
    stats: dict[str, ColumnStats] | None = None,
    workspace: Workspace | None = None,
) -> Deduplicated:
    """Remove repeats on the keys, unless that would cost more than ``limit`` of all rows.

    The hashes of keys that repeat, and the rows told apart by them, are written to ``workspace``.
    """
    status = DedupStatus()
    if keys is None:
        if schema is None:
            from sluicebox.operators.schema import detect_schema

            schema = detect_schema(df)
        keys = derive_keys(df, schema, year_names, stats)
    keys = [k for k in keys if k in df.columns]
    if not keys:
        status.reason = "No valid deduplication keys"
        log.warning("no deduplication keys; nothing was removed")
        return Deduplicated(df, status)

    status.keys = list(keys)
    work = Workspace(df.sparkSession) if workspace is None else workspace
    # The one shuffle of all keys; what repeats is written, and the rows are later tested against it.
    repeated = work.stage(key_counts(df, keys).where("n > 1"), "repeated-keys")
    found = repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys")).first()
    removed = found["rows"] - (0 if keep is False else found["keys"])
    rows = df.count() if removed else 0
    ratio = removed / rows if rows else 0.0
    if ratio > limit:
        status.aborted = True
        status.reason = f"Aborted: {ratio:.1%} rows would be removed"
        log.error("deduplication on %s aborted: %.1f%% of rows", keys, 100 * ratio)
        return Deduplicated(df, status)
    status.executed, status.removed = True, removed
    if not removed:
        return Deduplicated(df, status)
    alone, firsts = keep_one_of_repeated(df, keys, repeated, keep, order_by, work)
    return Deduplicated(alone if keep is False else alone.unionByName(firsts), status, alone, firsts)
