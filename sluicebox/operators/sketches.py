"""Mergeable summaries, merged in levels, so that no task merges the sketches of all others."""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Groups of tasks whose summaries are merged first, then groups of those; 400,000 tasks give about 100 summaries to a merge.
LEVELS = (4096, 64)


def merged(rows: DataFrame, keys: Sequence[str], summaries: Mapping[str, tuple[Column, Callable[[str], Column]]]) -> DataFrame:
    """One row per group: each summary, given as its aggregate over rows and the aggregate that merges such results."""
    part = F.spark_partition_id() % LEVELS[0]
    out = rows.withColumn("_part", part).groupBy(*keys, "_part").agg(*[first.alias(n) for n, (first, _) in summaries.items()])
    for width in (*LEVELS[1:], 1):
        out = out.withColumn("_part", F.col("_part") % width).groupBy(*keys, "_part").agg(
            *[merge(n).alias(n) for n, (_, merge) in summaries.items()])
    return out.drop("_part")


def counted(test: Column | None = None) -> tuple[Column, Callable[[str], Column]]:
    """A count of rows (that pass the test) as a summary."""
    return (F.count(F.lit(1)) if test is None else F.count_if(test)), F.sum


# --- frequent items

#: Values a summary of frequent items keeps, and the counters it has for them.
TRACKED, COUNTERS = 1000, 2048


def frequent_items(item: Column) -> tuple[Column, Callable[[str], Column]]:
    return F.call_function("approx_top_k_accumulate", item, F.lit(TRACKED)), lambda name: F.call_function(
        "approx_top_k_combine", F.col(name), F.lit(TRACKED))


def most_frequent(name: str, k: int) -> Column:
    """The k items that may be the most frequent, with estimates that are never below their counts."""
    return F.call_function("approx_top_k_estimate", F.col(name), F.lit(k))


def unseen_bound(rows: int, estimates: Sequence[int], k: int) -> float:
    """No item beyond those of `most_frequent` occurs more often.

    A summary of ``rows`` items is off by at most 3.5 * rows / COUNTERS; it leaves out items whose
    lower bound does not exceed that error, so these occur at most twice as often.
    """
    error = 2 * 3.5 * rows / COUNTERS
    return max(error, min(estimates)) if len(estimates) >= k else error


# --- distinct values

#: Size of a sketch of distinct values (2^17 bytes), and its relative error: six standard deviations of 1.04 / 2^8.5.
HLL_SIZE, HLL_ERROR = 17, 0.018


def distinct_sketch(item: Column) -> tuple[Column, Callable[[str], Column]]:
    return F.hll_sketch_agg(item, HLL_SIZE), lambda name: F.hll_union_agg(name)


def distinct_estimate(name: str) -> Column:
    return F.hll_sketch_estimate(name)


# --- quantiles

#: Size of a quantile sketch, and how far its ranks may be off (thrice the error that it keeps to with 99 % certainty).
KLL_SIZE, KLL_ERROR = 4096, 0.003


def quantile_sketch(value: Column) -> tuple[Column, Callable[[str], Column]]:
    return F.kll_sketch_agg_double(value, KLL_SIZE), lambda name: F.kll_merge_agg_double(name, KLL_SIZE)


def sketch_quantiles(name: str, fractions: Column) -> Column:
    """The values at these fractions of the ranks; NULL for a sketch without values."""
    return F.when(F.kll_sketch_get_n_double(name) > 0, F.kll_sketch_get_quantile_double(name, fractions))
