"""From a cleaned table to a written, checked one: suggest a plan, apply it, write, verify."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sluicebox import fixed_values as fv
from sluicebox.operators.transform import Transformed, apply_plan, suggest_plan
from sluicebox.operators.validate import check_written
from sluicebox.sources.artifacts import Artifacts
from sluicebox.sources.tables import write_table


@dataclass
class Written:
    table: str
    rows: int
    nulls: dict[str, int]
    transformed: Transformed


def save_plan(df: DataFrame, dataset: str, artifacts: Artifacts, enable_all: bool = False) -> dict:
    """Suggest a plan and save it where the user can edit it."""
    plan = suggest_plan(df, dataset, enable_all)
    artifacts.save(dataset, Artifacts.PLAN, plan)
    return plan


def apply_saved_plan(df: DataFrame, dataset: str, artifacts: Artifacts) -> Transformed:
    """Apply the saved plan and save the report of what was done; without a plan nothing changes."""
    done = apply_plan(df, artifacts.load(dataset, Artifacts.PLAN), dataset)
    if done.report:
        artifacts.save(dataset, Artifacts.EXECUTION, done.report)
    return done


def transform_to_table(
    spark: SparkSession, df: DataFrame, dataset: str, artifacts: Artifacts,
    allowed_nulls: tuple[str, ...] = fv.STRUCTURAL_SUFFIXES, expected_rows: int | None = None, strict: bool = False,
) -> Written:
    """Apply the saved plan, write the transformed table, check what was written and only then replace the old one.

    Casts and splits may make NULLs; they are reported, and refused only with ``strict``.
    """
    done = apply_saved_plan(df, dataset, artifacts)
    found = {}

    def check(staged):
        found["nulls"], found["rows"] = check_written(spark, staged, expected_rows, allowed_nulls, strict)

    table = write_table(done.df, dataset, check=check)
    return Written(table, found["rows"], found["nulls"], done)
