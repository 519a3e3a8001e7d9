"""Text cleaning and the string steps of a transform plan."""
from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from sluicebox import fixed_values as fv

# Every character Python counts as white space; Spark's own trim takes only U+0020.
WHITE_SPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())


def strip(cell: Column) -> Column:
    return F.trim(cell, F.lit(WHITE_SPACE))


def strip_edges(cell: Column) -> Column:
    """`strip` that passes most cells by; for a cell that is a column, as it is looked at several times."""
    return F.when(may_have_edge_space(cell), strip(cell)).otherwise(cell)


def is_wide(cell: Column) -> Column:
    """Whether the cell holds a character beyond ASCII."""
    return F.octet_length(cell) > F.length(cell)


def nfkc(cell: Column) -> Column:
    """Unicode NFKC by the ICU library that ships with Spark; pure ASCII cells pass untouched."""
    composed = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), cell, F.lit(True)
    )
    return F.when(is_wide(cell), composed).otherwise(cell)


def fix_mojibake(cell: Column) -> Column:
    for broken, mended in fv.MOJIBAKE:
        cell = F.replace(cell, F.lit(broken), F.lit(mended))
    return cell


def plain_punctuation(cell: Column) -> Column:
    """Typographic quotes and dashes as their ASCII forms."""
    return F.translate(cell, "“”‘’–—", "\"\"''--")


def needs_cleaning(cell: Column) -> Column:
    """Whether `clean_text` or `fix_mojibake` could change the cell; one quick look for most cells."""
    # One range is much faster to test than a class of several.
    return (
        cell.contains("  ") | cell.contains("[") | cell.contains("*") | cell.startswith(" ") | cell.endswith(" ")
        | cell.rlike(r"[^\x20-\x7E]")
    )


def clean_text(cell: Column, keep_punctuation: bool = False, mend: bool = False) -> Column:
    """Printable ASCII only: no bracketed notes, daggers, asterisks or control characters.

    One pass drops notes and unwanted characters together, which equals dropping
    them one after another because none of them is a bracket. With
    ``keep_punctuation`` typographic quotes and dashes become ASCII first
    instead of being dropped; with ``mend`` broken encodings are mended first.
    """
    steps = clean_text_steps(cell, keep_punctuation, mend)
    cleaned = steps[0](cell)
    for step in steps[1:]:
        cleaned = step(cleaned)
    return F.coalesce(cleaned, cell)


def clean_text_steps(cell: Column, keep_punctuation: bool = False, mend: bool = False) -> list[Callable[[Column], Column]]:
    """What `clean_text` does to ``cell``, one step after the other; NULL from the first on where there is nothing to clean.

    A step looks at its input several times, so in a projection of its own each of them is computed once for a cell.
    """
    def raw(given):
        # Only characters beyond ASCII are mended, put in another form or told as ASCII.
        out = fix_mojibake(given) if mend else given
        out = plain_punctuation(out) if keep_punctuation else out
        out = F.when(is_wide(given), out).otherwise(given) if mend or keep_punctuation else given
        return nfkc(F.when(needs_cleaning(cell), out))

    return [raw, _printable, _single_blanks]


def _printable(cell: Column) -> Column:
    return F.regexp_replace(F.replace(cell, F.lit("*"), F.lit("")), r"\[[^\]]*\]|[^\x20-\x7E]", "")


def _single_blanks(cell: Column) -> Column:
    return F.trim(F.when(cell.contains("  "), F.regexp_replace(cell, " {2,}", " ")).otherwise(cell))


def is_one_of(cell: Column, words: Sequence[str]) -> Column:
    """Whether the cell is one of the words, by a look into a set of them."""
    # Longer cells need no look; a NULL cell stays NULL.
    return (F.octet_length(cell) <= max((len(w.encode()) for w in words), default=0)) & cell.isin(list(words))


def may_have_edge_space(cell: Column) -> Column:
    """False for cells that `strip` leaves alone, but for few; it looks at the first and the last character only."""
    last = F.right(cell, F.lit(1))
    return (cell < "!") | (cell >= "\x7f") | (last < "!") | (last >= "\x7f")


def null_missing(cell: Column, words: Sequence[str] = fv.MISSING_WORDS) -> Column:
    """NULL for cells that only spell out that a value is missing."""
    return F.when(~is_one_of(cell, words), cell)


def normalize_delimiters(cell: Column) -> Column:
    """One comma without surrounding blanks for each of ``; : / ,``."""
    return F.regexp_replace(cell, r"\s*[;:/,]\s*", ",")


def split_multi_values(cell: Column) -> Column:
    """Lower case, stripped, with ``;`` as ``,``; the cell stays one string."""
    return F.replace(strip(F.lower(cell)), F.lit(";"), F.lit(","))


def multi_values(cell: Column) -> Column:
    """The parts of a multi-valued cell as an array."""
    return F.split(normalize_delimiters(cell), ",")

