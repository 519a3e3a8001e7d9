"""CSV in: strings first, then types from one pass over the values."""
from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluicebox import fixed_values as fv
from sluicebox.functions.parsing import parse_number
from sluicebox.functions.text import clean_text, clean_text_steps, null_missing
from sluicebox.operators.columns import clean_names, header_names
from sluicebox.operators.distinct_cells import distinct_cells, weighted
from sluicebox.operators.profile import ROW_ORDER, column, data_columns, in_steps, kinds
from sluicebox.plans.workspace import Workspace
from sluicebox.sources.records import read_records

log = logging.getLogger(__name__)

LATIN_NAMES = ("iso-8859-1", "latin-1", "latin1")
MALFORMED = "_malformed_record"


def resolve(path: str | Path, data_dir: str | Path | None = None) -> str:
    """The file meant: ``.csv`` added if missing, relative names looked up in ``data_dir``."""
    text = str(path)
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", text):
        return text
    found = Path(text)
    if data_dir is not None and not found.is_absolute():
        found = Path(data_dir) / found
    if not found.is_dir() and found.suffix.lower() != ".csv":
        found = found.with_name(found.name + ".csv")
    if not found.exists():
        raise FileNotFoundError(f"CSV file not found: {found}")
    return str(found)


def _read_whole(spark: SparkSession, path: str, encoding: str) -> tuple[DataFrame, list[str], int]:
    """Files in encodings whose lines cannot be told apart as bytes, each file in one task."""
    reader = spark.read.option("quote", '"').option("escape", '"').option("encoding", encoding).option("multiLine", True)
    head = reader.option("header", False).csv(path).first()
    if head is None:
        raise ValueError(f"no header in {path}")
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(head))]
    df = reader.option("header", True).option("columnNameOfCorruptRecord", MALFORMED).schema(
        T.StructType([*fields, T.StructField(MALFORMED, T.StringType())])).csv(path)
    return df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "*"), list(head), len(df.inputFiles())


def read_strings(
    spark: SparkSession, path: str, encoding: str = "utf-8", multi_line: bool = True, work: Workspace | None = None
) -> tuple[DataFrame, list[str]]:
    """The file as strings under positional names, with the order of its rows, and its header.

    Records with more or fewer cells than the header are also kept whole in the
    column MALFORMED.  Quoted cells may span lines, and files are read in splits
    all the same; ``multi_line=False`` spares the look at quotes.  Files read as
    UTF-8 whose bytes are not valid are read as Latin-1, each by itself.
    """
    charset = encoding.lower().replace("_", "-")
    if charset in ("utf-8", "utf8", *LATIN_NAMES):
        found = read_records(spark, path, multi_line, True if charset in LATIN_NAMES else None, work)
        if found.latin:
            log.warning("not valid UTF-8, read as Latin-1: %s", ", ".join(found.latin))
        head, files = found.header, found.files
        cells = ", ".join(f"c{i} string" for i in range(len(head)))
        options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
        parsed = F.from_csv("record", f"{cells}, {MALFORMED} string", options)
        df = found.df.select("file", "block", "row", parsed.alias("cells")).select("file", "block", "row", "cells.*")
    else:
        df, head, files = _read_whole(spark, path, encoding)
    names = header_names([(n.lstrip("\ufeff").strip() or None) if n else None for n in head])
    # Scans pack several files by size; the path and offset restore the order across files.
    order = F.struct("file", "block", "row") if files > 1 else F.col("row")
    return df.withColumn(ROW_ORDER, order).drop("file", "block", "row"), names


def _digits(txt):
    return F.when(txt.rlike(fv.WHOLE_NUMBER), txt.try_cast("bigint"))


def _texts(df: DataFrame) -> dict[int, str]:
    return dict(enumerate(c for c, k in kinds(df).items() if k == "text" and c != ROW_ORDER))


def _value_kinds(df: DataFrame, cells: DataFrame | None = None) -> dict[str, dict]:
    """Per string column: how many cells are filled, whole, numeric or boolean; ``cells`` are its `distinct_cells`, if at hand."""
    columns = _texts(df)
    if not columns:
        return {}
    txt, number = F.col("txt"), F.col("number")
    cells = distinct_cells(df, columns) if cells is None else cells
    counted = cells.withColumn("number", parse_number(txt)).groupBy("position").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("different"),
        weighted(txt.isNotNull()).alias("filled"),
        weighted(number.isNotNull() & txt.rlike(fv.WHOLE_NUMBER) & txt.try_cast("bigint").isNotNull()).alias("whole"),
        weighted(number.isNotNull() & (F.octet_length(txt) > 15) & (_digits(txt).cast("double").try_cast("bigint") != _digits(txt))).alias("beyond_double"),
        weighted(number.isNotNull()).alias("number"),
        weighted(txt.isin(*fv.CSV_BOOLEANS)).alias("boolean"),
    )
    return {columns[r["position"]]: r.asDict() for r in counted.collect()}


def infer_types(df: DataFrame, found: dict[str, dict] | None = None) -> DataFrame:
    """String columns as bigint, double or boolean where every filled cell is one.

    Whole numbers with gaps become double, unless that changes a digit, and
    booleans with gaps stay text.
    """
    found = _value_kinds(df) if found is None else found
    out = []
    for name in df.columns:
        cell, v = column(name), found.get(name)
        if v is not None:
            if v["whole"] == v["filled"] == v["rows"]:
                cell = cell.cast("bigint")
            elif v["whole"] == v["filled"] and v["beyond_double"]:
                cell = cell.cast("bigint")
            elif v["number"] == v["filled"]:
                cell = parse_number(cell)
            elif v["boolean"] == v["filled"] == v["rows"]:
                cell = F.lower(cell) == "true"
        out.append(cell.alias(name))
    return df.select(*out)


#: A column of at most so many different texts, and so many bytes of them, has each of them cleaned once.
WORDS, WORD_BYTES = 10_000, 1 << 20
#: Share of its cells that `distinct_cells` leaves of such a column, at most.
WORD_SHARE = 0.1


def _cleaned_words(texts: dict[int, str], cells: DataFrame, found: dict[str, dict], work: Workspace) -> dict[str, DataFrame]:
    """For those of the text columns, under their positions in ``cells``, that hold few texts: the table of these (word, cleaned)."""
    columns = {c: i for i, c in texts.items() if c in found and found[c]["different"] <= WORD_SHARE * found[c]["rows"]}
    if not columns:
        return {}
    words = cells.where(F.col("position").isin(list(columns.values())) & F.col("txt").isNotNull()).groupBy("position", "txt").agg(F.sum("n").alias("n"))
    words = work.stage(words, "words")
    sizes = words.groupBy("position").agg(F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("txt")).alias("bytes")).collect()
    few = {r["position"] for r in sizes if r["words"] <= WORDS and r["bytes"] <= WORD_BYTES}
    if not few:
        return {}
    cleaned = work.stage(words.where(F.col("position").isin(list(few))).select("position", "txt", clean_text(F.col("txt"), mend=True).alias("cleaned")), "cleaned-words")
    return {
        c: cleaned.where(F.col("position") == i).select(F.col("txt").alias(f"_word_{i}"), F.col("cleaned").alias(f"_known_{i}"))
        for c, i in columns.items() if i in few
    }


def clean_text_columns(df: DataFrame, keep_punctuation: bool = False, words: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every text column with broken encodings mended and reduced to clean ASCII.

    ``words`` has tables of the texts of some columns with what cleaning makes of them; a cell that is not among them is cleaned here.
    """
    kind, names = kinds(df), df.columns
    steps, known = {}, {}
    for i, c in enumerate(names):
        if kind[c] != "text" or c == ROW_ORDER:
            continue
        cell = column(c)
        if words and c in words:
            word, cleaned = words[c].columns
            df = df.join(F.broadcast(words[c]), column(c) == F.col(word), "left")
            known[c], cell = F.col(cleaned), F.when(F.col(word).isNull(), cell)
        first, *rest = clean_text_steps(cell, keep_punctuation, mend=True)
        steps[f"_cleaned_{i}"] = [first(cell), *rest]
    out = in_steps(df, steps)
    return out.select(*[
        F.coalesce(*([known[c]] if c in known else []), F.col(f"_cleaned_{i}"), column(c)).alias(c) if f"_cleaned_{i}" in steps else column(c)
        for i, c in enumerate(names)
    ])


def load_frame(
    df: DataFrame, missing_words: Sequence[str] = fv.CSV_MISSING_WORDS, infer: bool = True, workspace: Workspace | None = None
) -> DataFrame:
    """What reading a CSV does after the scan, for any table: names, gaps, types, clean text.

    With a ``workspace`` its different texts are written, and those of columns with few of them are cleaned once.
    """
    kind = kinds(df)
    names = data_columns(df)
    new = dict(zip(names, clean_names(names)))
    df = df.select(*[
        (null_missing(column(c), missing_words) if kind[c] == "text" else column(c)).alias(new.get(c, c))
        for c in df.columns
    ])
    if not infer:
        return clean_text_columns(df)
    if workspace is None or not _texts(df):
        return clean_text_columns(infer_types(df))
    cells = workspace.stage(distinct_cells(df, _texts(df)), "cells")
    found = _value_kinds(df, cells)
    typed = infer_types(df, found)
    still = set(_texts(typed).values())
    words = _cleaned_words({i: c for i, c in _texts(df).items() if c in still}, cells, found, workspace)
    return clean_text_columns(typed, words=words)


def read_csv(
    spark: SparkSession,
    path: str | Path,
    data_dir: str | Path | None = None,
    encoding: str = "utf-8",
    multi_line: bool = True,
    missing_words: Sequence[str] = fv.CSV_MISSING_WORDS,
    clean: bool = True,
    strict: bool = False,
    workspace: Workspace | None = None,
) -> DataFrame:
    """A CSV file or directory as a typed table with clean names and, unless switched off, clean text.

    Records that do not have as many cells as the header are counted and
    reported; ``strict`` refuses them.  Files whose headers differ are refused.
    Files that are not valid UTF-8 are read as Latin-1, each by itself.  What
    the reading stages goes to ``workspace``.
    """
    where = resolve(path, data_dir)
    strings, header = read_strings(spark, where, encoding, multi_line, workspace)
    named = strings.toDF(*clean_names(header), MALFORMED, ROW_ORDER)
    marked = named.select(*[
        column(c) if c in (ROW_ORDER, MALFORMED) else null_missing(column(c), missing_words).alias(c) for c in named.columns
    ])
    found = _value_kinds(marked)
    malformed = found.pop(MALFORMED, {}).get("filled", 0)
    if malformed:
        log.warning("%s: %s records do not have as many cells as the header", where, malformed)
        if strict:
            raise ValueError(f"{where}: {malformed} records do not have as many cells as the header")
    typed = infer_types(marked.drop(MALFORMED), found)
    return clean_text_columns(typed) if clean else typed


def list_csv(spark: SparkSession, directory: str | Path) -> list[str]:
    """The CSV files of a directory in any store that Spark reads, sorted by name."""
    where = spark._jvm.org.apache.hadoop.fs.Path(str(directory))
    files = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return sorted(f.getPath().toString() for f in files if f.getPath().getName().lower().endswith(".csv"))
