"""What to know about a stored dataset at a glance, and its exports."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sluicebox.operators.report import describe, headline, null_percent, year_end_notice
from sluicebox.sources.tables import find_table, read_table, write_csv, write_text


@dataclass
class Overview:
    database: str
    table: str
    df: DataFrame
    headline: DataFrame
    null_percent: DataFrame
    structural_gaps: list[str]

    def describe(self) -> DataFrame:
        return describe(self.df)

    def export_csv(self, path: str) -> str:
        return write_csv(self.df, path)

    def export_text(self, path: str) -> str:
        return write_text(self.df, path)


def overview(spark: SparkSession, part_of_name: str) -> Overview:
    """The first stored table whose name contains the text: rows, columns, gaps and where they are expected."""
    database, table = find_table(spark, part_of_name)
    df = read_table(spark, database, table)
    return Overview(database, table, df, headline(df), null_percent(df), year_end_notice(df))
