"""Strings to numbers, years and timestamps, with NULL where the cell does not fit."""
from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, functions as F

from sluicebox import fixed_values as fv
from sluicebox.functions.text import is_wide, strip, strip_edges


def parse_number(cell: Column) -> Column:
    """A string as double; NULL where the whole cell is not a number, or too large for a double.

    Spark's own cast also takes ``1d`` or ``1f``, so the shape is checked first.
    Comparisons of bytes spare most other cells the pattern, and short cells
    without an exponent are in range and are cast once.
    """
    value = cell.try_cast("double")
    starts = ((cell < ":") & ((cell < "!") | (cell >= "+")) & ~cell.contains("/")) | cell.startswith("i") | cell.startswith("I")
    small = (F.octet_length(cell) < 300) & ~cell.contains("e") & ~cell.contains("E")
    in_range = small | (F.abs(value) < F.lit(float("inf"))) | cell.rlike("(?i)inf")
    return F.when(starts & cell.rlike(fv.NUMBER) & in_range, value)


def is_whole(number: Column) -> Column:
    """True for finite numbers without a fraction."""
    return (F.rint(number) == number) & (F.abs(number) < F.lit(float("inf")))


def number_text(number: Column) -> Column:
    """A double as text that keeps large whole values out of exponent notation."""
    plain = is_whole(number) & (F.abs(number) < F.lit(1e16))
    return F.when(plain, F.concat(number.try_cast("bigint").cast("string"), F.lit(".0"))).otherwise(
        number.cast("string")
    )


def bare_amount(cell: Column) -> Column:
    """The cell without white space around it and without notes."""
    inner = strip_edges(cell)
    return F.when(cell.contains("["), F.regexp_replace(inner, r"\[[^\]]*\]", "")).otherwise(inner)


def amount_digits(amount: Column) -> Column:
    return F.regexp_replace(amount, r"[^0-9.\-]", "")


def amount_number(amount: Column, digits: Column) -> Column:
    """The number that the digits of a bare amount stand for, with its suffix."""
    ending = F.when(
        functools.reduce(operator.or_, [amount.endswith(c) for c in "KMBkmb,\n"]), F.regexp_extract(amount, r"(?d)([KMBkmb]),*$", 1)
    )
    scale = F.lit(1.0)
    for letter, factor in fv.SUFFIX_SCALE:
        scale = F.when(F.upper(ending) == letter, F.lit(factor)).otherwise(scale)
    return parse_number(digits) * scale


def clean_numeric(cell: Column) -> Column:
    """The amount written in a cell such as ``$1,200[a]`` or ``3.5M``; NULL where there is none."""
    amount = bare_amount(cell)
    return amount_number(amount, amount_digits(amount))


def clean_numeric_or_keep(cell: Column) -> Column:
    """`clean_numeric` as text, keeping the original cell where it holds no amount."""
    return F.coalesce(number_text(clean_numeric(cell)), cell)


def years_in(cell: Column) -> Column:
    """All years in the cell; a four-digit number that follows another one at once counts as a number of its own."""
    dashed = F.when(is_wide(cell), F.regexp_replace(cell, "[–—−]", "-")).otherwise(cell)
    apart = F.when(F.octet_length(cell) >= 8, F.regexp_replace(dashed, r"(\d{4})(?=\d{4})", "$1-")).otherwise(dashed)
    return F.regexp_extract_all(apart, F.lit(fv.YEAR), F.lit(1))


def bounds_of(years: Column) -> tuple[Column, Column]:
    """First of the years, and the last one if there are several."""
    return F.try_element_at(years, F.lit(1)).cast("bigint"), F.when(F.size(years) > 1, F.try_element_at(years, F.lit(-1))).cast("bigint")


def year_bounds(cell: Column) -> tuple[Column, Column]:
    """First year in the cell, and the last one if it names more than one."""
    return bounds_of(years_in(cell))


def parse_date(cell: Column, format_name: str) -> Column:
    """The cell read with one named format of `fixed_values.DATE_FORMATS`."""
    for name, shape, pattern in fv.DATE_FORMATS:
        if name == format_name:
            return F.when(cell.rlike(shape), F.try_to_timestamp(strip_edges(cell), F.lit(pattern)))
    raise ValueError(f"unknown date format: {format_name}")


def parse_boolean(cell: Column) -> Column:
    word = F.lower(cell)
    return F.when(word.isin(*fv.BOOLEAN_WORDS), word.isin(*fv.TRUE_WORDS))


def split_year(cell: Column) -> tuple[Column, Column]:
    """Whole numbers before and after the first ``-``; NULL where a side is no number."""
    parts = F.split(cell, "-", 2)
    sides = []
    for position in (1, 2):
        number = parse_number(F.try_element_at(parts, F.lit(position)))
        sides.append(F.when(is_whole(number), number.try_cast("bigint")))
    return sides[0], sides[1]
