"""Catalog tables, JDBC tables and file sinks."""
from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluicebox import fixed_values as fv
from sluicebox.operators.columns import clean_name
from sluicebox.operators.profile import ROW_ORDER, column, data_columns

BATCH_ROWS = 5000


def base_name(dataset: str) -> str:
    """The dataset's name without extension or trailing time stamp."""
    stem = re.sub(r"\.(csv|parquet)$", "", dataset, flags=re.IGNORECASE)
    return re.sub(r"_\d{8}_\d{6}$", "", stem)


def _public(df: DataFrame) -> DataFrame:
    return df.select(*[column(c) for c in data_columns(df)])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# --- catalog

def list_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases() if d.name not in fv.SYSTEM_DATABASES]


def list_tables(spark: SparkSession, databases: list[str] | None = None) -> list[tuple[str, str]]:
    databases = list_databases(spark) if databases is None else databases
    return [(d, t.name) for d in databases for t in spark.catalog.listTables(d) if not t.isTemporary]


def find_table(spark: SparkSession, part_of_name: str) -> tuple[str, str]:
    """The first table whose name contains the text, in any case."""
    for database, table in list_tables(spark):
        if part_of_name.lower() in table.lower():
            return database, table
    raise LookupError(f"no table contains {part_of_name!r} in its name")


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{_quoted(database)}.{_quoted(table)}")


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _files(spark: SparkSession, folder: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _point(spark: SparkSession, name: str, schema: T.StructType, file_format: str, where: str) -> str | None:
    """Let the table ``name`` show the files at ``where``; the place it showed before.

    A table of the same columns takes one change of its location, so readers see the old rows or the new ones.
    Other columns need a new entry in the catalog: the old one steps aside until that stands, and comes back if it fails.
    """
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, where, file_format, schema)
        return None
    before = _described(spark, name)
    columns = lambda fields: [(f.name, f.dataType.simpleString()) for f in fields]
    if before.get("Type") == "EXTERNAL" and before.get("Provider", "").lower() == file_format and columns(spark.table(name).schema) == columns(schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
        return before["Location"]
    aside = f"{name[:-1]}_{uuid.uuid4().hex[:8]}`"
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.catalog.createTable(name, where, file_format, schema)
    except BaseException:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {aside}")
    return before.get("Location")


def write_table(df: DataFrame, dataset: str, file_format: str = "parquet", check=None) -> str:
    """Replace ``<dataset>.transformed_<dataset>``, creating the database if needed.

    Rows are written to a new place under the database's location.  Only if ``check(source)``, which may read
    them there, does not raise does the table change over to them.  The version before stays for
    those who still read it; older ones are deleted.
    """
    base = clean_name(base_name(dataset))
    spark, rows = df.sparkSession, _public(df)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(base)}")
    name = f"{_quoted(base)}.{_quoted('transformed_' + base)}"
    folder = f"{spark.catalog.getDatabase(base).locationUri}/versions_{base}"
    where = f"{folder}/{uuid.uuid4().hex}"
    rows.write.format(file_format).save(where)
    try:
        if check is not None:
            check(f"{file_format}.`{where}`")
        before = _point(spark, name, rows.schema, file_format, where)
    except BaseException:
        path, system = _files(spark, where)
        system.delete(path, True)
        raise
    kept = {where.rsplit("/", 1)[1], (before or "").rstrip("/").rsplit("/", 1)[-1]}
    path, system = _files(spark, folder)
    for version in system.listStatus(path):
        if version.getPath().getName() not in kept:
            system.delete(version.getPath(), True)
    return name


# --- JDBC

def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
    partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 64,
) -> DataFrame:
    """A database table; give a partition column and its bounds to read it in parallel."""
    reader = spark.read.format("jdbc").options(**dict(properties or {})).option("url", url).option("dbtable", table)
    if partition_column is not None:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", partition_column).option("lowerBound", str(low))
            .option("upperBound", str(high)).option("numPartitions", partitions)
        )
    return reader.load()


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
    connections: int = 16, batch_rows: int = BATCH_ROWS,
) -> None:
    """Replace a database table, with at most ``connections`` tasks writing at once."""
    (
        _public(df).write.format("jdbc").mode("overwrite").options(**dict(properties or {}))
        .option("url", url).option("dbtable", table)
        .option("batchsize", batch_rows).option("numPartitions", connections).save()
    )


# --- files

def write_csv(df: DataFrame, path: str) -> str:
    """A directory of CSV files with a header, replacing what was there; blanks at the edges of cells stay."""
    (
        _public(df).write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    _public(df).write.mode("overwrite").parquet(path)
    return path


def write_text(df: DataFrame, path: str, separator: str = "\t") -> str:
    """One line of text per row; gaps are empty."""
    line = F.concat_ws(separator, *[F.coalesce(column(c).cast("string"), F.lit("")) for c in data_columns(df)])
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned table written by `write_parquet` or `write_csv`; CSV types are found again."""
    from sluicebox.sources.csv import read_csv

    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if not names.select("path").limit(1).isEmpty():
        return spark.read.parquet(path)
    return read_csv(spark, path, clean=False).drop(ROW_ORDER)
