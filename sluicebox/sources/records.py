"""CSV records of files that are read in splits, although quoted cells may span lines.

A line alone does not tell whether it begins inside a quoted cell, but it tells
what it does in either case: ``opens``, whether a reader that enters it
outside leaves it inside, and ``keeps``, whether one that enters inside stays.
Such effects compose like numbers add, so prefix sums of them at two levels, over
the lines of a block and over the blocks of a file, give the state at every line.
All of it is built-in expressions.

A first pass counts per block (the splits Spark makes of a file).  Blocks
without a line that opens a cell need no order at all: their lines are records,
but for those up to the first that closes a cell of an earlier block.  Only
lines of other blocks are shuffled, one block to a group, and only the pieces of
records that do span lines are put together.  Each file is decoded by itself: as
UTF-8 where all its bytes are valid, and otherwise as Latin-1.
"""
from __future__ import annotations

import csv
import io
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.window import WindowSpec

from sluicebox.plans.workspace import Workspace

LATIN = "ISO-8859-1"

# Cells up to a comma: quoted ones with whatever follows the closing quote, or plain ones.  A quote inside a plain cell is a
# character like any other.  All repetitions are possessive, so a line is read once and without recursion.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELLS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+,)*+'
OPENS = rf'^{_CELLS}"{_INSIDE}\z'
KEEPS = rf'^{_INSIDE}(?:"[^,]*+,{_CELLS}"{_INSIDE})?+\z'


@dataclass
class Records:
    """file, block, row, record of every record but the headers; the parsed header; files that were read as Latin-1."""

    df: DataFrame
    header: list[str]
    files: int
    latin: list[str]


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row, line: lines as they are stored, undecoded; row grows within a block."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"))


def line_effects(line: Column) -> tuple[Column, Column]:
    """opens, keeps; most lines have no quote and leave either state as it is."""
    quoted = line.contains('"')
    return quoted & line.rlike(OPENS), ~quoted | line.rlike(KEEPS)


def states_before(df: DataFrame, opens: str, keeps: str, rows: WindowSpec) -> DataFrame:
    """Adds from_out and from_in: whether a row begins inside a cell if the first one begins outside, or inside.

    Since the last row that leaves one state whatever it met, each row that opens and does not keep has turned the state.
    """
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col(opens) & ~F.col(keeps)
    fixed = F.col(opens) == F.col(keeps)
    df = df.withColumn("_turned", F.coalesce(F.sum(turns.cast("long")).over(before), F.lit(0)))
    df = df.withColumn("_fixed", F.last(F.when(fixed, F.struct(F.col(opens).alias("state"), F.col("_turned").alias("at"))), True).over(before))
    odd = ((F.col("_turned") - F.coalesce(F.col("_fixed.at"), F.lit(0))) % 2) == 1
    since = lambda first: F.coalesce(F.col("_fixed.state"), F.lit(first)) != odd
    return df.withColumn("from_out", since(False)).withColumn("from_in", since(True)).drop("_turned", "_fixed")


def _not_blank(line: Column) -> Column:
    return F.octet_length(F.trim(line)) > 0


def _block_table(lines: DataFrame, multi_line: bool) -> DataFrame:
    line = F.col("line")
    opens, keeps = line_effects(line) if multi_line else (F.lit(False), F.lit(True))
    return lines.groupBy("file", "block").agg(
        F.min(F.when(_not_blank(line), F.col("row"))).alias("first_row"), F.max("row").alias("last_row"),
        F.count_if(opens).alias("openers"), F.min(F.when(~keeps, F.col("row"))).alias("first_closer"),
        F.count_if(~F.is_valid_utf8(line)).alias("invalid"))


def _inner_states(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """The lines of blocks with openers: their effects, their state and the last line before them that begins a record, for both states at the block's begin."""
    some = blocks.where("openers > 0").select("file", "block")
    opens, keeps = line_effects(F.col("line"))
    marked = lines.join(some, ["file", "block"]).withColumns({"opens": opens, "keeps": keeps})
    rows = Window.partitionBy("file", "block").orderBy("row")
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    marked = states_before(marked, "opens", "keeps", rows)
    return marked.withColumns({
        f"start_{side}": F.last(F.when(~F.col(f"from_{side}"), F.col("row")), True).over(before) for side in ("out", "in")})


def _block_states(blocks: DataFrame, inner: DataFrame) -> DataFrame:
    """Each block's state at its begin, and the last line before it that begins a record."""
    after = lambda side: F.when(F.col(f"from_{side}"), F.col("keeps")).otherwise(F.col("opens"))
    start = lambda side: F.max(F.when(~F.col(f"from_{side}"), F.col("row")))
    ends = inner.groupBy("file", "block").agg(
        F.max_by(after("out"), "row").alias("out_after"), F.max_by(after("in"), "row").alias("in_after"),
        start("out").alias("out_start"), start("in").alias("in_start"))
    open_ = F.col("openers") > 0
    known = blocks.join(ends, ["file", "block"], "left").select(
        *blocks.columns,
        F.when(open_, F.col("out_after")).otherwise(F.lit(False)).alias("out_after"),
        F.when(open_, F.col("in_after")).otherwise(F.col("first_closer").isNull()).alias("in_after"),
        F.when(open_, F.col("out_start")).otherwise(F.col("last_row")).alias("out_start"),
        F.when(open_, F.col("in_start")).when(F.col("first_closer") < F.col("last_row"), F.col("last_row")).alias("in_start"))
    rows = Window.partitionBy("file").orderBy("block")
    known = states_before(known, "out_after", "in_after", rows).withColumn("inside", F.col("from_out"))
    last = F.when(F.col("inside"), F.col("in_start")).otherwise(F.col("out_start"))
    owner = F.when(last.isNotNull(), F.struct("block", last.alias("row")))
    return known.withColumn("owner", F.last(owner, True).over(rows.rowsBetween(Window.unboundedPreceding, -1)))


def _spanning(lines: DataFrame, inner: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of one line, and pieces of longer ones under the place of the line that begins them."""
    states = blocks.select("file", "block", "inside", "owner", "first_closer", "openers")
    plain = lines.join(states.where("openers = 0"), ["file", "block"])
    head = F.col("inside") & (F.col("first_closer").isNull() | (F.col("row") <= F.col("first_closer")))
    whole = plain.where(~head).select("file", "block", "row", "line")
    pieces = plain.where(head).select("file", F.col("owner.block").alias("at_block"), F.col("owner.row").alias("at_row"), "block", "row", "line")

    known = inner.join(states.where("openers > 0"), ["file", "block"])
    by_state = lambda name: F.when(F.col("inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    known = known.withColumns({"goes_on": by_state("from"), "start": by_state("start")})
    whole = whole.unionByName(known.where(~F.col("goes_on") & ~F.col("opens")).select("file", "block", "row", "line"))
    local = F.struct("block", F.col("start").alias("row"))
    place = F.when(~F.col("goes_on"), F.struct("block", "row")).when(F.col("start").isNotNull(), local).otherwise(F.col("owner"))
    spread = known.where(F.col("goes_on") | F.col("opens")).withColumn("place", place)
    return whole, pieces.unionByName(spread.select("file", F.col("place.block").alias("at_block"), F.col("place.row").alias("at_row"), "block", "row", "line"))


def _parsed(header: str) -> list[str]:
    return next(csv.reader(io.StringIO(header.lstrip("\ufeff"), newline="")))


def read_records(spark: SparkSession, path: str, multi_line: bool = True, latin: bool | None = None, work: Workspace | None = None) -> Records:
    """The records of a CSV file or a directory of them, in as many tasks as there are splits.

    Quotes open a cell at its begin only and are doubled inside; line ends inside cells become ``\\n``.  Blank lines
    between records are skipped.  Without ``multi_line`` every line is a record.  ``latin`` decodes all files as Latin-1 (True) or
    UTF-8 (False); without it each file goes by its own bytes.  Each file begins with the same header (up to case).
    A quote that is never closed makes the rest of its file one record.
    Tables between the passes are written to ``work``: a row for each block, and the lines of blocks in which cells are opened.
    """
    work = Workspace(spark) if work is None else work
    lines = scan_lines(spark, path)
    blocks = work.stage(_block_table(lines, multi_line), "csv-blocks")
    if blocks.where("openers > 0").isEmpty():
        whole, pieces = lines, None
    else:
        inner = work.stage(_inner_states(lines, blocks), "csv-lines")
        blocks = work.stage(_block_states(blocks, inner), "csv-states")
        whole, pieces = _spanning(lines, inner, blocks)
    records = whole.where(_not_blank(F.col("line"))).withColumnRenamed("line", "record")
    if pieces is not None:
        ordered = F.sort_array(F.collect_list(F.struct("block", "row", "line")))
        glued = pieces.groupBy("file", "at_block", "at_row").agg(F.array_join(F.transform(ordered, lambda p: p["line"]), "\n").alias("record"))
        records = records.unionByName(glued.select("file", F.col("at_block").alias("block"), F.col("at_row").alias("row"), "record"))

    header = F.min(F.when(F.col("first_row").isNotNull(), F.struct("block", F.col("first_row").alias("row"))))
    files = work.stage(blocks.groupBy("file").agg(header.alias("header"), (F.sum("invalid") > 0).alias("is_latin")), "csv-files")
    latin_file = F.col("is_latin") if latin is None else F.lit(latin)
    decoded = F.when(latin_file, F.decode(F.col("record").cast("binary"), LATIN)).otherwise(F.col("record"))
    records = records.join(files, "file").withColumn("record", decoded)
    is_header = (F.col("block") == F.col("header.block")) & (F.col("row") == F.col("header.row"))
    seen = [_parsed(r["record"]) for r in records.where(is_header).select("record").distinct().limit(100).collect()]
    if not seen:
        raise ValueError(f"no header in {path}")
    if len({tuple(name.strip().lower() for name in names) for names in seen}) > 1:
        raise ValueError(f"the headers of the files in {path} differ: {seen[:2]}")
    warned = [r["file"] for r in files.where("is_latin").orderBy("file").limit(10).collect()] if latin is None else []
    return Records(records.where(~is_header).select("file", "block", "row", "record"), seen[0], files.count(), warned)
