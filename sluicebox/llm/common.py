"""What several operators share: staged tables, the tokens of the contracts, spread over tasks."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.plans.workspace import Workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of letters, digits and everything beyond ASCII, after A-Z were lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Runs without ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; all other characters as they are, whatever the locale."""
    return F.translate(text, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(df: DataFrame) -> Workspace:
    """A new folder under ``spark.checkpoint.dir`` for tables written between passes."""
    return Workspace(df.sparkSession)


def parts(amount: float, each: float) -> int:
    """How many tasks get ``each`` of ``amount``; grows with the amount."""
    return max(1, math.ceil((amount or 0) / each))
