"""One distributed aggregate that measures every column at once.

Columns are stacked into long form and grouped by column name, so the plan does
not grow with columns times predicates and the shuffle carries one row per
column and task.  Everything the driver reads is a handful of counts per column.
"""
from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from sluicebox import fixed_values as fv
from sluicebox.functions.parsing import is_whole, number_text, parse_date, parse_number
from sluicebox.functions.text import is_one_of, is_wide, may_have_edge_space, strip
from sluicebox.operators import sketches
from sluicebox.operators.distinct_cells import distinct_cells, weighted

ROW_ORDER = "_row_ord"

_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)
_TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Groups of counts that `measure` can take.
ALL_GROUPS = ("dirt", "years", "identity", "letters", "numbers", "values", "flags", "dates", "marks", "missing")


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.StringType):
        return "text"
    if isinstance(data_type, _WHOLE_TYPES) or isinstance(data_type, T.DecimalType) and data_type.scale == 0 and data_type.precision <= 18:
        return "whole"
    if isinstance(data_type, _FRACTION_TYPES):
        return "fraction"
    if isinstance(data_type, T.BooleanType):
        return "flag"
    if isinstance(data_type, _TIME_TYPES):
        return "time"
    return "other"


def kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: kind_of(f.dataType) for f in df.schema.fields}


def data_columns(df: DataFrame) -> list[str]:
    """All columns but the row order the sources add."""
    return [c for c in df.columns if c != ROW_ORDER]


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def without_nan(name: str, kind: str) -> Column:
    if kind != "fraction":
        return column(name)
    value = column(name).cast("double")
    return F.when(~F.isnan(value), value)


def cell_text(name: str, kind: str) -> Column:
    if kind == "fraction":
        return number_text(without_nan(name, kind))
    if kind == "other":
        return F.when(column(name).isNotNull(), F.lit(""))
    return column(name).cast("string")


def cell_number(name: str, kind: str) -> Column:
    if kind in ("whole", "fraction"):
        return without_nan(name, kind).cast("double")
    if kind == "flag":
        return column(name).cast("int").cast("double")
    return F.lit(None).cast("double")


def in_steps(df: DataFrame, steps: dict[str, Sequence[Column | Callable[[Column], Column]]]) -> DataFrame:
    """The table with added columns, each computed from an expression and then step by step from its own last value.

    Every step is a projection of its own: an expression that a rule names several times would be computed as often.
    """
    for i in range(max((len(s) for s in steps.values()), default=0)):
        df = df.withColumns({
            name: s[i] if isinstance(s[i], Column) else s[i](column(name)) for name, s in steps.items() if i < len(s)
        })
    return df


def stack(df: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One output row per entry of ``rows`` for each input row."""
    flat = [value for row in rows for value in row]
    return df.select(F.stack(F.lit(len(rows)), *flat).alias(*names))


@dataclass(frozen=True)
class DistinctRange:
    """How many distinct values a column may have, as a sketch tells it: to be compared with limits outside of it, never shown."""

    low: int
    high: int

    def holds(self, limit: float) -> bool:
        return self.low <= limit <= self.high


@dataclass
class ColumnStats:
    """Counts of one column; ``counts`` holds whatever groups were measured."""

    name: str
    kind: str
    rows: int = 0
    filled: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    low: float | None = None
    high: float | None = None
    distinct: int | DistinctRange | None = None

    def changed(self, **changes) -> ColumnStats:
        """A copy with other counts, for a column that a step rewrote in a known way."""
        counts = {**self.counts, **changes.pop("counts", {})}
        return replace(self, counts=counts, **changes)

    @property
    def nulls(self) -> int:
        return self.rows - self.filled

    def of_filled(self, name: str) -> float:
        return self.counts.get(name, 0) / self.filled if self.filled else 0.0

    def of_rows(self, name: str) -> float:
        return self.counts.get(name, 0) / self.rows if self.rows else 0.0

    @property
    def null_ratio(self) -> float:
        return self.nulls / self.rows if self.rows else 0.0

    @property
    def least_distinct(self) -> int:
        """Distinct values, at least; on the right side of every limit that `settle_distinct` was given."""
        return self.distinct.low if isinstance(self.distinct, DistinctRange) else self.distinct or 0

    @property
    def uniqueness(self) -> float:
        """Distinct values per filled row, as `least_distinct` has them."""
        return self.least_distinct / self.filled if self.filled else 0.0

    def best_date_format(self) -> tuple[str | None, int]:
        """The format most cells fit, and how many do; earlier formats win ties."""
        best, fits = None, 0
        for name, _, _ in fv.DATE_FORMATS:
            if self.counts.get(f"date_{name}", 0) > fits:
                best, fits = name, self.counts[f"date_{name}"]
        return best, fits


def _date_like(txt: Column) -> Column:
    shapes = "|".join(shape.strip("^$") for _, shape, _ in fv.DATE_FORMATS)
    # Every shape holds two separators with something between them and ends in a digit, which white space may follow.
    last = F.right(txt, F.lit(1))
    ends = (last < ":") | (last >= "\x7f")
    return (F.octet_length(txt) >= 8) & ends & _any(txt.contains(c) for c in "-/ ") & txt.rlike("[-/ ][^-/ ]++[-/ ]") & txt.rlike(f"^(?:{shapes})$")


def _has_letter(txt: Column) -> Column:
    """Letters have two cases; only cells beyond ASCII need the pattern."""
    return F.when(is_wide(txt), txt.rlike(fv.HAS_LETTER)).otherwise(F.upper(txt) != F.lower(txt))


def _any(tests: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, tests)


def _text_counters(groups: Sequence[str]) -> dict[str, Column]:
    """The tests on a text cell.  Plain substring looks spare most cells the regex behind them."""
    txt, number = F.col("txt"), F.col("number")
    suffixed = _any(txt.endswith(c) for c in "KMBkmb\n") & txt.rlike(fv.MONEY_SUFFIX)
    plain, letters = txt.rlike(fv.PLAIN_NUMBER), _has_letter(txt)
    of = {
        "dirt": lambda: {
            "text_dirty": (_any(txt.contains(c) for c in "[*") | txt.rlike(fv.TEXT_DIRTY_CHARACTERS)) & txt.rlike(fv.TEXT_DIRTY),
            "money_dirty": _any(txt.contains(c) for c in fv.MONEY_CHARACTERS) | suffixed,
            "year_range": (txt.contains("19") | txt.contains("20")) & txt.rlike(fv.YEAR_RANGE),
        },
        "years": lambda: {"year": txt.rlike(fv.YEAR)},
        "identity": lambda: {
            "id_value": (F.octet_length(txt) >= 8) & letters & ~txt.contains(" ") & txt.rlike(fv.ID_VALUE)
        },
        "letters": lambda: {
            "letters": letters,
            "plain_number": number.isNotNull() & plain if "numbers" in groups else plain,
        },
        # "numbers" parses text, "values" only looks at columns that are numeric already.
        "numbers": lambda: {**_number_counters(number), **_digit_counters(txt, number)},
        "values": lambda: {} if "numbers" in groups else dict.fromkeys(_number_counters(number), F.lit(False)),
        "flags": lambda: {"boolean_word": (F.octet_length(txt) <= 5) & F.lower(txt).isin(*fv.BOOLEAN_WORDS)},
        "dates": lambda: {"date_like": _date_like(txt)},
        "marks": lambda: {
            "delimiter": txt.rlike(fv.DELIMITER),
            "dash": txt.contains("-"),
            "edge_blank": txt.startswith(" ") | txt.endswith(" "),
        },
        "missing": lambda: {
            "missing_word": is_one_of(txt, fv.MISSING_WORDS),
            "edge_space": may_have_edge_space(txt) & (F.octet_length(strip(txt)) < F.octet_length(txt)),
        },
    }
    return {name: test for group in groups for name, test in of[group]().items()}


def _number_counters(number: Column) -> dict[str, Column]:
    return {
        "parsed": number.isNotNull(),
        "whole": is_whole(number),
        "infinite": F.abs(number) == F.lit(float("inf")),
        "in_years": number.between(fv.YEAR_LOW, fv.YEAR_HIGH),
    }


def _digit_counters(txt: Column, number: Column) -> dict[str, Column]:
    """Whole numbers of 64 bits, and those of them that a double cannot hold; up to 15 digits it holds all."""
    digits = F.when(number.isNotNull() & txt.rlike(fv.WHOLE_NUMBER), txt.try_cast("bigint"))
    return {"fits": digits.isNotNull(), "beyond_double": (F.octet_length(txt) > 15) & (digits.cast("double").try_cast("bigint") != digits)}


def _aggregate(long: DataFrame, counters: dict[str, Column], with_range: bool, count: Callable[[Column], Column] = F.count_if) -> DataFrame:
    """Grouped by a small integer instead of the column's name."""
    out = [count(F.lit(True)).alias("rows"), count(F.col("is_filled")).alias("filled")]
    out += [count(test).alias(name) for name, test in counters.items()]
    if with_range:
        finite = F.when(F.abs(F.col("number")) < F.lit(float("inf")), F.col("number"))
        out += [F.min(finite).alias("low"), F.max(finite).alias("high")]
    return long.groupBy("position").agg(*out)


def _count_text(df: DataFrame, texts: Sequence[tuple[int, str]], counters: dict[str, Column], groups: Sequence[str]) -> DataFrame:
    long = distinct_cells(df, dict(texts))
    added = [F.col("txt").isNotNull().alias("is_filled")]
    if "numbers" in groups:
        added.append(parse_number(F.col("txt")).alias("number"))
    elif "values" in groups:
        added.append(F.lit(None).cast("double").alias("number"))
    return _aggregate(long.select("*", *added), counters, len(added) > 1, weighted)


def _count_others(df: DataFrame, others: Sequence[tuple[int, str]], wanted: Iterable[str], groups: Sequence[str]) -> DataFrame:
    kind = kinds(df)
    nothing, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    rows = []
    for i, c in others:
        k = kind[c]
        is_number = k in ("whole", "fraction")
        rows.append((
            F.lit(i), cell_number(c, k) if is_number else nothing,
            cell_text(c, k) if {"dirt", "years"} & set(groups) and is_number else no_text,
            without_nan(c, k).isNotNull(), F.lit(k),
        ))
    long = stack(df, rows, ("position", "number", "txt", "is_filled", "kind"))
    txt, number, kind_ = F.col("txt"), F.col("number"), F.col("kind")
    flag = (kind_ == "flag") & F.col("is_filled")
    tests = {
        **_number_counters(number),
        "year": txt.rlike(fv.YEAR),
        "year_range": (F.octet_length(txt) >= 8) & txt.rlike(fv.YEAR_RANGE),
        "boolean_word": flag | ((kind_ == "whole") & number.isin(0.0, 1.0)),
        "letters": flag,
    }
    return _aggregate(long, {n: tests[n] for n in wanted if n in tests}, {"numbers", "values"} & set(groups))


def _counted(df: DataFrame, columns: Sequence[str], groups: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Counts by position of the column, and their names; a count that cannot apply to a column is NULL."""
    unknown = set(groups) - set(ALL_GROUPS)
    if unknown:
        raise ValueError(f"unknown groups of counts: {sorted(unknown)}")
    kind = kinds(df)
    counters = _text_counters(groups)
    texts = [(i, c) for i, c in enumerate(columns) if kind[c] == "text"]
    others = [(i, c) for i, c in enumerate(columns) if kind[c] != "text"]
    parts = []
    if texts:
        parts.append(_count_text(df, texts, counters, groups))
    if others:
        parts.append(_count_others(df, others, counters, groups))
    counted = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return counted, list(counters)


def measure(df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """Counts per column as a table: column, kind, rows, filled, then one column per count.

    Text and other columns are stacked apart, so that each side reads only its
    columns and runs only the tests that can apply.  The tests together must stay
    small enough for the JVM to compile; dates are therefore only recognised by
    shape here and parsed by `date_counts`.
    """
    columns = data_columns(df) if columns is None else list(columns)
    if not columns:
        raise ValueError("a table without columns cannot be measured")
    kind = kinds(df)
    counted, names = _counted(df, columns, groups)
    by_position = F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(kind[c]) for c in columns])
    labels = [F.get(values, F.col("position")) for values in by_position]
    counts = [
        F.coalesce(F.col(n), F.lit(0)).alias(n) if n in counted.columns else F.lit(0).cast("bigint").alias(n)
        for n in names
    ]
    rest = [c for c in ("low", "high") if c in counted.columns]
    return counted.select(
        "position", labels[0].alias("column"), labels[1].alias("kind"), "rows", "filled", *counts, *rest
    )


def _gaps(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnStats]:
    """Rows and filled cells by one plain aggregate; nothing has to be stacked for that."""
    kind = kinds(df)
    row = df.agg(F.count(F.lit(1)), *[F.count(without_nan(c, kind[c])) for c in columns]).first()
    return {c: ColumnStats(c, kind[c], row[0], n) for c, n in zip(columns, row[1:])}


def gap_stats(df: DataFrame) -> dict[str, ColumnStats]:
    """`collect_stats` for reports on gaps: numeric columns that have some are also counted by value."""
    stats = collect_stats(df)
    wanted = [c for c, s in stats.items() if s.nulls and s.kind in ("whole", "fraction")]
    return {**stats, **collect_stats(df, wanted, ("values",))}


def date_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, int]]:
    """How many cells of each text column can be read with each date format."""
    columns = list(columns)
    names = [name for name, _, _ in fv.DATE_FORMATS]
    found = {c: {f"date_{name}": 0 for name in names} for c in columns}
    if columns:
        counts = [weighted(parse_date(F.col("txt"), name).isNotNull()).alias(f"date_{name}") for name in names]
        for row in distinct_cells(df, dict(enumerate(columns))).groupBy("position").agg(*counts).collect():
            found[columns[row["position"]]].update({f"date_{name}": row[f"date_{name}"] for name in names})
    return found


def collect_stats(
    df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = (), parse_dates: bool = True
) -> dict[str, ColumnStats]:
    """`measure` read to the driver: one small row per column, in schema order.

    Columns that mostly look like dates get a second pass that parses them.
    """
    columns = data_columns(df) if columns is None else list(columns)
    kind = kinds(df)
    found = {}
    if columns and not groups:
        found = _gaps(df, columns)
    elif columns:
        counted, names = _counted(df, columns, groups)
        for row in counted.collect():
            values, c = row.asDict(), columns[row["position"]]
            found[c] = ColumnStats(
                c, kind[c], row["rows"], row["filled"], {n: values.get(n) or 0 for n in names},
                values.get("low"), values.get("high"),
            )
        dates = [c for c, s in found.items() if s.of_filled("date_like") >= fv.DATE_THRESHOLD]
        for name, counts in date_counts(df, dates if parse_dates else []).items():
            found[name].counts.update(counts)
    return {c: found.get(c, ColumnStats(c, kind[c])) for c in columns}


def cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filled cells in long form: column, and the value as txt, num or whole by its kind.

    Whole numbers keep 64 bits, and text sorts as text.
    """
    kind = kinds(df)
    none = {"txt": F.lit(None).cast("string"), "num": F.lit(None).cast("double"), "whole": F.lit(None).cast("bigint")}
    rows = []
    for name in columns:
        value = dict(none)
        k = kind[name]
        if k == "whole":
            value["whole"] = column(name).cast("bigint")
        elif k == "flag":
            value["whole"] = column(name).cast("int").cast("bigint")
        elif k == "fraction":
            value["num"] = without_nan(name, k)
        elif k == "other":
            value["txt"] = F.to_json(F.struct(column(name)))
        else:
            value["txt"] = column(name).cast("string")
        rows.append((F.lit(name), value["txt"], value["num"], value["whole"]))
    long = stack(df, rows, ("column", "txt", "num", "whole"))
    return long.where("txt IS NOT NULL OR num IS NOT NULL OR whole IS NOT NULL")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value occurs; a hot value shrinks to one row per task before the shuffle."""
    return cells(df, columns).groupBy("column", "txt", "num", "whole").agg(F.count(F.lit(1)).alias("n"))


def distinct_frame(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct filled values per column, counted over 128 bits of hash of every value.

    Two numbers travel per distinct value and task, however long the values are.
    """
    return _hashed(cells(df, columns)).select("column", "h1", "h2").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """`distinct_frame` read to the driver; columns without values have 0."""
    columns = list(columns)
    counts = {r["column"]: r["distinct"] for r in distinct_frame(df, columns).collect()} if columns else {}
    return {name: counts.get(name, 0) for name in columns}


def distinct_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, DistinctRange]:
    """Bounds of the distinct counts from sketches; one sketch per column and task travels, and no value."""
    columns = list(columns)
    if not columns:
        return {}
    merged = sketches.merged(_hashed(cells(df, columns)), ["column"], {"sketch": sketches.distinct_sketch(F.col("h1")), "filled": sketches.counted()})
    out = dict.fromkeys(columns, DistinctRange(0, 0))
    for row in merged.select("column", "filled", sketches.distinct_estimate("sketch").alias("n")).collect():
        margin = sketches.HLL_ERROR * row["n"] + 1
        out[row["column"]] = DistinctRange(max(math.floor(row["n"] - margin), 1), min(math.ceil(row["n"] + margin), row["filled"]))
    return out


def settle_distinct(df: DataFrame, stats: dict[str, ColumnStats], columns: Sequence[str], limits: Callable[[ColumnStats], Sequence[float]]) -> None:
    """Know of each column on which side of its limits the number of distinct values lies.

    A sketch decides for most; values are only counted where a limit lies within its bounds.
    """
    unknown = [c for c in columns if stats[c].distinct is None]
    for name, bounds in distinct_ranges(df, unknown).items():
        stats[name].distinct = bounds
    near = [
        c for c in columns
        if isinstance(stats[c].distinct, DistinctRange) and any(stats[c].distinct.holds(limit) for limit in limits(stats[c]))
    ]
    for name, n in distinct_counts(df, near).items():
        stats[name].distinct = n


def _hashed(long: DataFrame) -> DataFrame:
    """Cells with 128 bits of hash of their value."""
    value = F.struct("txt", (F.col("num") + 0.0).alias("num"), "whole")
    return long.withColumn("h1", F.xxhash64(value)).withColumn("h2", F.xxhash64(F.lit(1), value))


#: Values that are counted exactly for each column, as the most frequent may be among them.
CANDIDATES = 20


def _candidates(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[list[int], float]]:
    """Per column: hashes of values that may be the most frequent, and how often any other value can occur."""
    rows = _hashed(cells(df, columns))
    summary = sketches.merged(rows, ["column"], {"items": sketches.frequent_items(F.col("h1")), "rows": sketches.counted()})
    out = {}
    for row in summary.select("column", "rows", sketches.most_frequent("items", CANDIDATES).alias("items")).collect():
        estimates = [item["count"] for item in row["items"]]
        out[row["column"]] = [item["item"] for item in row["items"]], sketches.unseen_bound(row["rows"], estimates, CANDIDATES)
    return out


def _counted_candidates(df: DataFrame, hashes: dict[str, list[int]]) -> list[Row]:
    """Exact counts and values of the candidates of each column; no other cell leaves its task."""
    columns = list(hashes)
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column")).cast("int") - 1
    wanted = F.get(F.array(*[F.array(*[F.lit(h).cast("bigint") for h in hashes[c]]) for c in columns]), place)
    # The few values that pass are the keys of the groups: numbers to add up, and nothing to sort.
    return _hashed(cells(df, columns)).where(F.array_contains(wanted, F.col("h1"))).groupBy("column", "whole", "num", "txt").agg(
        F.count(F.lit(1)).alias("n")).collect()


def _rare_modes(df: DataFrame, columns: Sequence[str]) -> list[Row]:
    """Modes of columns in which no value stands out.

    Hashes are counted first.  Where all occur once, the mode is the column's least value, and no value has to travel.
    """
    counts = _hashed(cells(df, columns)).groupBy("column", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    most = {r["column"]: r["most"] for r in counts.groupBy("column").agg(F.max("n").alias("most")).collect()}
    least = F.min(F.struct("whole", "num", "txt")).alias("value")
    out = []
    single = [c for c, n in most.items() if n == 1]
    if single:
        out += cells(df, single).groupBy("column").agg(F.lit(1).cast("bigint").alias("n"), least).select("column", "n", "value.*").collect()
    several = {c: n for c, n in most.items() if n > 1}
    if several:
        valued = _hashed(cells(df, list(several))).groupBy("column", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), least)
        top = functools.reduce(operator.or_, [(F.col("column") == c) & (F.col("n") == n) for c, n in several.items()])
        out += valued.where(top).groupBy("column").agg(F.first("n").alias("n"), F.min("value").alias("value")).select(
            "column", "n", "value.*").collect()
    return out


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Row]:
    """column, n, and the value as whole, num or txt: the most frequent value, the smallest among equally frequent ones.

    A summary of frequent items names a few candidates per column and bounds the count of all others; the candidates are
    then counted exactly.  Where the best of them beats the bound it is the mode, and no values were
    shuffled.  Only the remaining columns have all their values counted.
    """
    columns = list(columns)
    if not columns:
        return {}
    found = _candidates(df, columns)
    out, open_ = {}, []
    counted: dict[str, list[Row]] = {c: [] for c in found}
    for row in _counted_candidates(df, {c: hashes for c, (hashes, _) in found.items() if hashes}) if any(h for h, _ in found.values()) else []:
        counted[row["column"]].append(row)
    for name, (_, bound) in found.items():
        most = max((r["n"] for r in counted[name]), default=0)
        if most > bound:
            best = [r for r in counted[name] if r["n"] == most]
            out[name] = min(best, key=lambda r: next(v for v in (r["whole"], r["num"], r["txt"].encode() if r["txt"] is not None else None) if v is not None))
        else:
            open_.append(name)
    if open_:
        out.update({r["column"]: r for r in _rare_modes(df, open_)})
    return {c: out[c] for c in columns if c in out}


MODE_SCHEMA = "column string, n bigint, whole bigint, num double, txt string"


def mode_frame(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`modes` as a table; columns without values have no row."""
    return df.sparkSession.createDataFrame([tuple(r[c] for c in ("column", "n", "whole", "num", "txt")) for r in modes(df, columns).values()], MODE_SCHEMA)


def collect_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """The mode of each column as a literal of the column's type; all-NULL columns are left out."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for name, row in modes(df, columns).items():
        value = next(v for v in (row["whole"], row["num"], row["txt"]) if v is not None)
        out[name] = F.lit(value).cast(types[name])
    return out
