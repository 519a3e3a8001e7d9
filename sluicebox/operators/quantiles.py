"""Exact linear quantiles of many columns without holding a column in one task.

A quantile between two ranks is the line between two order statistics.  A first
scan draws an evenly spaced grid of approximate quantiles per column from KLL
sketches, which are merged in levels; the grid cells around a wanted rank,
widened by the sketch's error, must hold it.  A plain count of the values below, at and
between the ends tells whether the rank falls on an end.  If not, and the interval
holds a few values only, they are gathered and the rank is read off;
otherwise a new grid inside the interval narrows it more than hundredfold.  So
10^12 rows take about seven scans, and no scan shuffles the values.
"""
from __future__ import annotations

import functools
import math
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from sluicebox.operators import sketches
from sluicebox.operators.profile import cell_number, kinds, stack

# At most so many values are gathered per interval.
BOUND = 200_000
GRID = 1000
# Spark sorts its input once an aggregate of objects sees more groups than this.
GROUPS = 100
# Intervals whose ends are counted in one scan.
TARGETS = 24


def _rank_pair(n: int, p: float) -> tuple[int, int]:
    position = (n - 1) * p
    return math.floor(position), math.ceil(position)


def _chunks(items: Sequence, size: int = GROUPS):
    return [items[i:i + size] for i in range(0, len(items), size)]


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kind = kinds(df)
    return stack(df, [(F.lit(i), cell_number(c, kind[c])) for i, c in enumerate(columns)], ("position", "value"))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    filled: Mapping[str, int] | None = None,
    bound: int | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles per numeric column; ``None`` for columns without values.

    ``filled`` gives the non-NULL counts when the caller already has them.
    """
    columns = list(columns)
    bound = BOUND if bound is None else bound
    if not columns:
        return {}
    if filled is None:
        counted = _numbers(df, columns).groupBy("position").agg(F.count("value").alias("n"))
        counts = {r["position"]: r["n"] for r in counted.collect()}
        filled = {c: counts.get(i, 0) for i, c in enumerate(columns)}
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    large = [c for c in columns if filled[c]]
    ranks = sorted({(c, r) for c in large for p in probabilities for r in _rank_pair(filled[c], p)})
    found = _order_statistics(df, ranks, filled, bound)
    for c in large:
        for i, p in enumerate(probabilities):
            lower, upper = _rank_pair(filled[c], p)
            share = (filled[c] - 1) * p - lower
            low, high = found[c, lower], found[c, upper]
            out[c][i] = low if low == high else low + (high - low) * share
    return out


class _Interval:
    """Between two values that enclose the wanted ranks, and how many values it may hold."""

    def __init__(self, grid: Sequence[float], inner: int, size: int):
        steps = len(grid) - 1
        slack = sketches.KLL_ERROR * size + 1
        left = max(0, math.floor((inner - slack) / size * steps))
        right = min(steps, math.ceil((inner + 1 + slack) / size * steps))
        self.low, self.high = grid[left], grid[right]
        self.most = (right - left) / steps * size + 2 * sketches.KLL_ERROR * size

    @classmethod
    def between(cls, low: float, high: float):
        """A wider interval of unknown content, to be scanned with a new grid."""
        made = cls([low, high], 0, 1)
        made.most = math.inf
        return made


def _places(df: DataFrame, targets: Sequence[tuple[str, float, float]], kind: Mapping[str, str]) -> list[tuple[int, int, int, int]]:
    """Of each (column, low, high): how many values are below, at the low end, inside, and at the high end.

    One plain aggregate over the numeric columns; no row is put into another form for it.
    """
    counts = []
    for c, low, high in targets:
        value = cell_number(c, kind[c])
        counts += [value < low, value == low, (value > low) & (value < high), value == high]
    row = df.agg(*[F.count_if(test).alias(str(i)) for i, test in enumerate(counts)]).first()
    return [tuple(row[i:i + 4]) for i in range(0, len(counts), 4)]


def _order_statistics(df, ranks, filled, bound):
    """The value at each (column, zero-based rank)."""
    kind = kinds(df)
    fractions = F.expr("array(" + ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1)) + ")")
    found: dict[tuple[str, int], float] = {}
    open_: dict[tuple[str, int], _Interval] = {}
    wanted: dict[str, list[int]] = {}
    ends: dict[str, tuple[float, float]] = {}
    for c, r in ranks:
        wanted.setdefault(c, []).append(r)

    for columns in _chunks(list(wanted)):
        first = sketches.merged(_numbers(df, columns), ["position"], {
            "sketch": sketches.quantile_sketch(F.col("value")),
            "low": (F.min("value"), F.min), "high": (F.max("value"), F.max),
        })
        for row in first.select("position", sketches.sketch_quantiles("sketch", fractions).alias("grid"), "low", "high").collect():
            c = columns[row["position"]]
            ends[c] = row["low"], row["high"]
            for r in wanted[c]:
                if r == 0:
                    found[c, r] = row["low"]
                elif r == filled[c] - 1:
                    found[c, r] = row["high"]
                else:
                    open_[c, r] = _Interval(row["grid"], r, filled[c])

    while open_:
        # Ranks of one column that share an interval share its scan.
        targets: dict[tuple[str, float, float], list[tuple[int, _Interval]]] = {}
        for (c, r), interval in open_.items():
            targets.setdefault((c, interval.low, interval.high), []).append((r, interval))
        open_ = {}
        places = {key: place for part in _chunks(list(targets), TARGETS) for key, place in zip(part, _places(df, part, kind))}
        within: dict[tuple[str, float, float], list[tuple[int, _Interval]]] = {}
        for key, wanted_here in targets.items():
            (c, low_value, high_value), (before, at_low, inside, at_high) = key, places[key]
            start = before + at_low
            for r, interval in wanted_here:
                if before <= r < start:
                    found[c, r] = low_value
                elif start <= r < start + inside:
                    within.setdefault(key, []).append((r - start, interval))
                elif start + inside <= r < start + inside + at_high:
                    found[c, r] = high_value
                else:
                    # The sketch was worse than promised: look on the side where the rank must be.
                    least, most = ends[c]
                    open_[c, r] = _Interval.between(least, low_value) if r < before else _Interval.between(high_value, most)
        for part in _chunks(list(within), TARGETS):
            rows = []
            for i, (c, low, high) in enumerate(part):
                gather = places[c, low, high][2] <= bound
                rows.append((F.lit(i), cell_number(c, kind[c]), F.lit(low), F.lit(high), F.lit(gather)))
            value = F.col("value")
            # Only values inside an interval go on to be gathered or sketched.
            near = functools.reduce(operator.or_, [(cell_number(c, kind[c]) > low) & (cell_number(c, kind[c]) < high) for c, low, high in part])
            inner = stack(df.where(near), rows, ("target", "value", "low", "high", "gather")).where((value > F.col("low")) & (value < F.col("high")))
            scanned = sketches.merged(inner, ["target"], {
                "values": (F.collect_list(F.when(F.col("gather"), value)), lambda name: F.flatten(F.collect_list(name))),
                "sketch": sketches.quantile_sketch(F.when(~F.col("gather"), value)),
            }).withColumn("values", F.sort_array("values")).withColumn("grid", sketches.sketch_quantiles("sketch", fractions))
            # Only the wanted entries of a gathered interval come back, not its values.
            wanted_ranks = F.get(
                F.array(*[F.array(*[F.lit(r).cast("bigint") for r, _ in within[key]]) for key in part]),
                F.col("target"),
            )
            picked = F.transform(wanted_ranks, lambda r: F.get("values", r.cast("int")))
            for row in scanned.withColumn("picked", picked).drop("values", "sketch").collect():
                key = part[row["target"]]
                before, at_low, inside, _ = places[key]
                for (inner_rank, _), picked_value in zip(within[key], row["picked"]):
                    r = before + at_low + inner_rank
                    if row["grid"] is None:
                        found[key[0], r] = picked_value
                    else:
                        open_[key[0], r] = _Interval(row["grid"], inner_rank, inside)
    return found
