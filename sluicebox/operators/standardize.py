"""Choose a cleaner for each column from measured ratios, and apply it in one projection."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from sluicebox import fixed_values as fv
from sluicebox.functions.parsing import amount_digits, amount_number, bare_amount, bounds_of, number_text, parse_date, years_in
from sluicebox.functions.text import clean_text, strip_edges
from sluicebox.operators.profile import (
    ColumnStats, cell_text, collect_stats, column, data_columns, in_steps, kinds, settle_distinct,
)

ID, DATE, YEAR, MONEY, TEXT, STRIP, KEEP = "id", "date", "year", "numeric", "text", "strip", "keep"
CLEANING_ROUTES = (DATE, YEAR, MONEY, TEXT)
SKIPPING_ROUTES = (ID, STRIP)


def name_looks_like_id(name: str) -> bool:
    name = name.lower()
    return name in fv.ID_NAMES or name.endswith("_id")


def value_looks_like_id(stats: ColumnStats) -> bool:
    return stats.filled > 0 and stats.of_filled("id_value") >= fv.ID_VALUE_THRESHOLD


def is_highly_unique(stats: ColumnStats) -> bool:
    return stats.filled > 0 and stats.uniqueness >= fv.UNIQUE_THRESHOLD


def needs_uniqueness(stats: ColumnStats) -> bool:
    """With both other signals or with neither, uniqueness cannot change the answer."""
    return name_looks_like_id(stats.name) != value_looks_like_id(stats)


def is_id(stats: ColumnStats) -> bool:
    """At least two of: an id-like name, id-like values, nearly all values distinct."""
    signals = (name_looks_like_id(stats.name), value_looks_like_id(stats))
    return all(signals) or (any(signals) and is_highly_unique(stats))


def looks_like_text(stats: ColumnStats) -> bool:
    return (
        stats.filled > 0
        and stats.of_filled("letters") >= fv.LETTER_THRESHOLD
        and stats.of_filled("plain_number") < fv.PLAIN_NUMBER_LIMIT
    )


def add_uniqueness(df: DataFrame, stats: dict[str, ColumnStats]) -> None:
    """Settle `distinct` for the columns whose id decision depends on it."""
    open_ = [c for c, s in stats.items() if s.filled and needs_uniqueness(s)]
    settle_distinct(df, stats, open_, lambda s: [fv.UNIQUE_THRESHOLD * s.filled])


def route(stats: ColumnStats) -> str:
    """The cleaner for one column; pure arithmetic on its counts, first hit wins."""
    if is_id(stats):
        return ID
    text_dirty = stats.of_filled("text_dirty") >= fv.TEXT_THRESHOLD
    if text_dirty and stats.filled and stats.best_date_format()[1] / stats.filled >= fv.DATE_THRESHOLD:
        return DATE
    # A cell with two years also holds one, so the range ratio decides alone.
    if stats.of_filled("year_range") >= fv.YEAR_THRESHOLD:
        return YEAR
    if stats.of_filled("money_dirty") >= fv.MONEY_THRESHOLD:
        return MONEY
    if looks_like_text(stats):
        return TEXT if text_dirty else STRIP
    return KEEP


@dataclass
class Standardized:
    df: DataFrame
    routes: dict[str, str]
    stats: dict[str, ColumnStats] = field(default_factory=dict)

    @property
    def cleaned(self) -> list[str]:
        return [c for c, r in self.routes.items() if r in CLEANING_ROUTES]

    @property
    def skipped(self) -> list[str]:
        return [c for c, r in self.routes.items() if r in SKIPPING_ROUTES]

    @property
    def rewrites(self) -> bool:
        return bool(self.cleaned)


def profile_routes(
    df: DataFrame, stats: dict[str, ColumnStats] | None = None
) -> tuple[dict[str, str], dict[str, ColumnStats]]:
    """Routes of all columns, and the counts they come from."""
    if stats is None:
        stats = collect_stats(df, groups=("dirt", "identity", "letters"))
    add_uniqueness(df, stats)
    # Dates only matter for columns that are mostly dirty text; usually there are none.
    maybe_dates = [c for c, s in stats.items() if s.of_filled("text_dirty") >= fv.TEXT_THRESHOLD]
    if maybe_dates:
        cleaned = df.select(*[clean_text(column(c)).alias(c) for c in maybe_dates])
        raw_dates = collect_stats(df, maybe_dates, ("dates",))
        clean_dates = collect_stats(cleaned, groups=("dates",))
        for name in maybe_dates:
            stats[name].counts.update(raw_dates[name].counts)
            stats[name].counts["clean_date_format"] = clean_dates[name].best_date_format()[0]
    return {c: route(s) for c, s in stats.items()}, stats


# The groups that hold for a column as long as its cells stay the same.
LASTING_GROUPS = ("identity", "numbers", "flags", "dates")
PROFILE_GROUPS = ("dirt", "letters", "missing", *LASTING_GROUPS)


def lasting_stats(standard: Standardized) -> dict[str, ColumnStats]:
    """Counts of the standardised table with missing words as NULL, measuring rewritten columns only.

    Needs stats with all `PROFILE_GROUPS`.  No missing word is a number, a truth
    value, a date or an id, so only the filled count of a kept column changes.
    """
    from sluicebox.operators.missing import normalize_missing

    kept, again = {}, []
    for name in data_columns(standard.df):
        s, chosen = standard.stats.get(name), standard.routes.get(name)
        same = chosen == KEEP or (chosen in SKIPPING_ROUTES and s.counts["edge_space"] == 0)
        if not same:
            again.append(name)
            continue
        kind = "text" if chosen in SKIPPING_ROUTES and s.kind != "whole" else s.kind
        kept[name] = s.changed(kind=kind, filled=s.filled - s.counts["missing_word"])
    if again:
        rewritten = normalize_missing(standard.df.select(*[column(c) for c in again]))
        kept.update(collect_stats(rewritten, groups=LASTING_GROUPS, parse_dates=False))
    return {c: kept[c] for c in data_columns(standard.df)}


def standardize(df: DataFrame, stats: dict[str, ColumnStats] | None = None) -> Standardized:
    """Each column cleaned by its route, in one lazy projection."""
    routes, stats = profile_routes(df, stats)
    kind, names = kinds(df), df.columns
    projected, extra, steps = [], [], {}
    for i, name in enumerate(names):
        cell = column(name)
        chosen = routes.get(name, KEEP)
        # The long rules go step by step, in columns of their own.
        if chosen == DATE:
            date_format = stats[name].counts["clean_date_format"] or stats[name].best_date_format()[0]
            steps[f"_step_{i}"] = [clean_text(cell), lambda text, date_format=date_format: parse_date(text, date_format)]
            projected.append(F.col(f"_step_{i}").alias(name))
        elif chosen == YEAR:
            steps[f"_step_{i}"] = [years_in(cell_text(name, kind[name]))]
            first, last = bounds_of(F.col(f"_step_{i}"))
            projected.append(first.alias(name))
            extra.append((f"{name}_end", last))
        elif chosen == MONEY:
            amount = bare_amount(cell.cast("string"))
            steps[f"_amount_{i}"] = [amount]
            steps[f"_step_{i}"] = [amount_digits(amount), lambda digits, i=i: amount_number(F.col(f"_amount_{i}"), digits)]
            projected.append(F.coalesce(number_text(F.col(f"_step_{i}")), cell).alias(name))
        elif chosen == TEXT:
            projected.append(clean_text(cell).alias(name))
        elif chosen in (ID, STRIP) and kind[name] != "whole":
            projected.append(strip_edges(cell_text(name, kind[name])).alias(name))
        else:
            projected.append(cell)
    taken = {name for name, _ in extra}
    projected = [p for p, name in zip(projected, names) if name not in taken]
    out = in_steps(df, steps).select(*projected, *[value.alias(name) for name, value in extra])
    return Standardized(out, routes, stats)
