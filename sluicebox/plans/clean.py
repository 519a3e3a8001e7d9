"""Clean one table: profile, standardise, impute, type, deduplicate, validate."""
from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

from sluicebox.operators import outliers
from sluicebox.operators.columns import drop_sparse_columns
from sluicebox.operators.dedup import DedupStatus, remove_duplicates
from sluicebox.operators.missing import drop_null_rows, fill_constant, impute, normalize_missing
from sluicebox.operators.profile import ColumnStats, collect_stats, gap_stats
from sluicebox.operators.report import missing_counts
from sluicebox.operators.schema import apply_schema, detected_type, profile_types
from sluicebox.operators.standardize import LASTING_GROUPS, MONEY, PROFILE_GROUPS, lasting_stats, standardize
from sluicebox.operators.validate import Validation, validate
from sluicebox.plans.workspace import Workspace
from sluicebox.sources.artifacts import Artifacts
from sluicebox.sources.csv import load_frame, read_csv


@dataclass
class CleanRun:
    """The cleaned table and all that was decided on the way."""

    df: DataFrame
    dataset: str
    shape: tuple[int, int]
    routes: dict[str, str]
    schema: dict[str, str]
    dedup: DedupStatus
    validation: Validation
    missing_before: DataFrame
    missing_after: DataFrame
    outliers_before: DataFrame | None = None
    outliers_after: DataFrame | None = None
    imputed: dict[str, int] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    workspace: Workspace | None = None


def _box_plots(df: DataFrame, columns: list[str], stats: dict[str, ColumnStats]) -> DataFrame | None:
    if not columns:
        return None
    return outliers.boxplot_stats(df, columns, outliers.quartile_bounds(df, columns, stats))


def clean_frame(
    df: DataFrame,
    dataset: str,
    strategy: str | None = "auto",
    fill_value=None,
    load: bool = True,
    with_outliers: bool = True,
    strict_boolean: bool = False,
    order_by: str | Column | None = None,
    workspace: Workspace | None = None,
    artifacts: Artifacts | None = None,
) -> CleanRun:
    """Run all cleaning steps on a table.

    The only actions are aggregates with one row per column (or per key for the
    duplicate count) and the tables written between passes: one after loading,
    so that raw text is parsed once, one after imputation, and one by a
    deduplication that removes rows.  A column is profiled once and again only
    if a step rewrote its cells; how coercing and filling change its counts is
    known without a look.  ``order_by`` tells which of several
    duplicates comes first; without it the row order of the source decides, or
    else the smallest row.
    """
    workspace = Workspace(df.sparkSession) if workspace is None else workspace
    if load:
        df = load_frame(df, workspace=workspace)
    df = workspace.stage(df, "loaded")

    # One pass counts for the missing-value report, outlier columns, routes and types alike.
    stats = collect_stats(df, groups=PROFILE_GROUPS, parse_dates=False)
    rows = max((s.rows for s in stats.values()), default=0)
    missing_before = missing_counts(df, stats)
    width = len(stats)
    box_before = _box_plots(df, outliers.eligible_by_values(df, stats), stats) if with_outliers else None

    standard = standardize(df, stats)
    dropped, counts, known = [], {}, None
    if strategy == "auto":
        amounts = tuple(c for c, r in standard.routes.items() if r == MONEY)
        imputed = impute(standard.df, amounts, lasting_stats(standard), LASTING_GROUPS)
        filled, dropped, known = imputed.df, list(imputed.dropped), imputed.stats
        counts = {"numeric": imputed.numeric, "text": imputed.text, "datetime": imputed.datetime}
    elif strategy == "drop":
        filled = drop_null_rows(standard.df)
    elif strategy == "fill":
        filled = fill_constant(standard.df, fill_value)
    else:
        filled = normalize_missing(standard.df)
    filled = workspace.stage(filled, "filled")

    if known is None:
        known = collect_stats(filled, groups=LASTING_GROUPS, parse_dates=False)
    type_stats = profile_types(filled, known)
    schema = {c: detected_type(s) for c, s in type_stats.items()}
    if artifacts is not None:
        artifacts.save(dataset, Artifacts.SCHEMA, schema)
    typed = apply_schema(filled, schema, type_stats, strict_boolean)
    null_ratios = {c: s.null_ratio for c, s in typed.stats.items()}
    kept, sparse = drop_sparse_columns(typed.df, null_ratios=null_ratios)
    box_after = _box_plots(kept, outliers.eligible_by_schema(kept, schema), typed.stats) if with_outliers else None

    kept_stats = {c: s for c, s in typed.stats.items() if c not in sparse}
    unique = remove_duplicates(kept, schema=schema, order_by=order_by, stats=kept_stats, workspace=workspace)
    # Where rows were removed, most of the others have been written.
    final = unique.df if unique.alone is None else unique.alone.unionByName(workspace.stage(unique.firsts, "firsts"))

    final_stats = gap_stats(final)
    missing_after = missing_counts(final, final_stats)
    result = validate(
        final, dataset, schema, unique.status, rows, final_stats, count_keys=unique.status.removed > 0
    )
    if artifacts is not None:
        artifacts.save(dataset, Artifacts.VALIDATION, result.as_dict())
    return CleanRun(
        final, dataset, (rows, width), standard.routes, schema, unique.status, result,
        missing_before, missing_after, box_before, box_after, counts, dropped + sparse, typed.warnings, workspace,
    )


def clean_csv(spark: SparkSession, path: str | Path, data_dir: str | Path | None = None, **options) -> CleanRun:
    """`clean_frame` for one CSV file; the file's name names the dataset.  Options of `read_csv` go to it."""
    reading = {n: options.pop(n) for n in ("encoding", "multi_line", "missing_words", "strict") if n in options}
    workspace = options.pop("workspace", None) or Workspace(spark)
    df = read_csv(spark, path, data_dir, workspace=workspace, **reading)
    return clean_frame(df, Path(str(path)).stem, load=False, workspace=workspace, **options)
