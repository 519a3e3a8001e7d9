"""The same run for every CSV file of a directory."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from sluicebox.plans.clean import CleanRun, clean_csv
from sluicebox.plans.transform import Written, save_plan, transform_to_table
from sluicebox.sources.artifacts import Artifacts
from sluicebox.sources.csv import list_csv, read_csv
from sluicebox.sources.tables import write_csv, write_parquet


@dataclass
class KeptRun:
    """A dataset whose file is as it was at the last run: what that run left of it."""

    df: DataFrame
    dataset: str
    schema: dict[str, str]
    validation: dict


def _state(spark: SparkSession, path: str, settings: str) -> dict:
    """Names, sizes and times of the file, or of the files of a directory, and the settings they were cleaned with."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return {"settings": settings, "files": sorted([f.getPath().getName(), f.getLen(), f.getModificationTime()] for f in files)}


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def clean_directory(
    spark: SparkSession, source: str | Path, target: str, artifacts: Artifacts, file_format: str = "parquet", skip_unchanged: bool = False, **options
) -> Iterator[CleanRun | KeptRun]:
    """Clean each file, write ``<target>/<dataset>_cleaned`` and free what the run staged.

    With ``skip_unchanged`` a file that has the size, time and settings of the last run that ended is not read
    again; its cleaned table, schema and validation are given as they were written.
    """
    write = {"csv": write_csv, "parquet": write_parquet}[file_format]
    read = spark.read.parquet if file_format == "parquet" else lambda where: read_csv(spark, where, clean=False)
    settings = repr((file_format, sorted(options.items())))
    for path in list_csv(spark, source):
        dataset, state = Path(path).stem, _state(spark, path, settings)
        where = f"{target}/{dataset}_cleaned"
        if skip_unchanged and artifacts.load(dataset, Artifacts.SOURCE) == state and _exists(spark, f"{where}/_SUCCESS"):
            yield KeptRun(read(where), dataset, artifacts.load(dataset, Artifacts.SCHEMA), artifacts.load(dataset, Artifacts.VALIDATION))
            continue
        run = clean_csv(spark, path, artifacts=artifacts, **options)
        write(run.df, where)
        # One row per column: kept, so that they can be read once the staged tables are gone.
        run.outliers_before, run.outliers_after = (
            None if df is None else spark.createDataFrame(df.collect(), df.schema) for df in (run.outliers_before, run.outliers_after))
        run.workspace.close()
        run.df = read(where)
        artifacts.save(dataset, Artifacts.SOURCE, state)
        yield run


def plan_directory(spark: SparkSession, cleaned: dict[str, str], artifacts: Artifacts) -> dict[str, dict]:
    """A saved plan per cleaned dataset, given as name and Parquet path."""
    return {name: save_plan(spark.read.parquet(path), name, artifacts) for name, path in cleaned.items()}


def transform_directory(spark: SparkSession, cleaned: dict[str, str], artifacts: Artifacts, **options) -> list[Written]:
    """Transform, write and check each cleaned dataset."""
    return [
        transform_to_table(spark, spark.read.parquet(path), name, artifacts, **options)
        for name, path in cleaned.items()
    ]
