"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source are laid out as one stream: shards in order, and in a
shard documents in a seeded order.  The stream is cut into blocks of equal
length.  The method of highest quotients (votes / 1, 3, 5, ...) deals out all
blocks of the mix to sources, by their targets, and then each source's blocks
to its shards, by the blocks they hold.  In a shard a seeded rotation picks the
blocks.  All of this is arithmetic on one row per (source, shard): no block is
ever a row, and a document's share follows from its place in the stream.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicebox.llm.common import TOKEN, table, workspace

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK = 64
SEED = "mix-1"


def _seeded(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    """Runs without white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """source, source_size, weight, target: words each source gives; one row per source.

    Sources by code point, null last, take the weights in turn.  What lies above
    ``repeats`` times a source's size is shared again by weight; that ends where
    every target is min(repeats * size, level * weight) for one common level.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(named) - 1) % len(weights) + 1)
    every = Window.partitionBy(F.lit(0))
    filling = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    levels = (
        totals.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward))
        .withColumn("level", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
        .withColumn("level", F.first("level", ignorenulls=True).over(
            filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def highest_quotients(votes: DataFrame, group: list[str], order: list[Column], seats: Column) -> DataFrame:
    """``votes`` (column votes) with ``quota``: Sainte-Laguë seats of each row among its group.

    ``seats`` is the number to deal out in the group.  With n rows that have
    votes, rounding votes / d deals out at most seats for d = total / (seats - n / 2)
    and at least seats for d = total / (seats + n / 2).  Only the quotients
    between the two, one more on either side for the floating point, are ranked:
    at most four a row on average.
    """
    every = Window.partitionBy(*(group or [F.lit(0)]))
    ranked = Window.partitionBy(*(group or [F.lit(0)])).orderBy(F.col("_quotient").desc(), *order)
    columns = votes.columns
    total = F.sum("votes").over(every)
    half = F.sum((F.col("votes") > 0).cast("long")).over(every) / 2

    def rounded(dealt: Column) -> Column:
        """Seats if a divisor is used that gives ``dealt`` proportional seats."""
        return F.when(total > 0, F.floor(F.col("votes") * dealt / total + 0.5)).otherwise(F.lit(0)).cast("long")

    based = (
        votes.withColumn("_seats", seats)
        .withColumn("_base", F.greatest(rounded(F.greatest(F.col("_seats") - half, F.lit(0.0))) - 1, F.lit(0)).cast("long"))
        .withColumn("_top", rounded(F.col("_seats") + half))
        .withColumn("_left", F.col("_seats") - F.sum("_base").over(every))
        .withColumn("_seat", F.explode(F.sequence("_base", "_top")))
        .withColumn("_quotient", F.col("votes") / (2 * F.col("_seat") + 1))
        .withColumn("_won", ((F.row_number().over(ranked) <= F.col("_left")) & (F.col("votes") > 0)).cast("long"))
    )
    return based.groupBy(*columns).agg((F.first("_base") + F.sum("_won")).cast("long").alias("quota"))


def mix_sources(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words the mix takes of each document.

    One row per input row.  Null or empty texts have size 0 and are taken 0
    times; a null source is a source of its own.  Rows that repeat a doc_id are
    documents of their own; equal rows are interchangeable.  An empty table
    gives no rows.  Only doc_id, source and text are read.
    """
    work = workspace(documents)
    sizes = work.stage(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    shards = max(1, math.ceil(math.sqrt(sizes.count())))
    placed = sizes.withColumn("order_key", _seeded(F.col("doc_id"))).withColumn(
        "shard", _number(F.col("order_key")) % shards)

    targets = source_targets(sizes).withColumn("votes", F.col("target"))
    seats = F.round(F.sum("votes").over(Window.partitionBy(F.lit(0))) / block).cast("long")
    dealt = highest_quotients(targets, [], [F.col("source").asc_nulls_last()], seats).select(
        "source", "source_size", "target",
        F.least("quota", F.ceil(F.col("source_size") / block) * REPEATS).alias("seats"))
    dealt = work.stage(dealt, "sources")

    along = Window.partitionBy("source").orderBy("shard")
    begin = F.coalesce(F.sum("shard_size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    grid = (
        placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
        .withColumn("begin", begin)
        .withColumn("first", F.ceil(F.col("begin") / block))
        .withColumn("votes", F.ceil((F.col("begin") + F.col("shard_size")) / block) - F.col("first"))
    )
    grid = grid.join(dealt.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    quotas = highest_quotients(grid, ["source"], [F.col("shard")], F.col("seats"))
    quotas = (
        quotas.withColumn("blocks", F.col("votes"))
        .withColumn("full", F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(F.lit(0)))
        .withColumn("rest", F.when(F.col("blocks") > 0, F.col("quota") % F.col("blocks")).otherwise(F.lit(0)))
        .withColumn("turn", F.when(F.col("blocks") > 0, _number(_seeded(F.col("source"), F.col("shard"))) % F.col("blocks"))
                    .otherwise(F.lit(0)))
        # How often a shard's last block is taken: its end lies in the next shards.
        .withColumn("last", F.when(F.col("blocks") > 0, F.col("full") + (
            F.pmod(F.col("blocks") - 1 - F.col("turn"), F.col("blocks")) < F.col("rest")).cast("long")))
        .withColumn("head", F.coalesce(F.last("last", ignorenulls=True).over(
            along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "begin", "first", "blocks",
                "full", "rest", "turn", "head", "source_size", "target")
    )
    quotas = work.stage(quotas, "quotas")

    stream = Window.partitionBy("source", "shard").orderBy("order_key", "doc_id", "size")
    local = F.coalesce(F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = (
        placed.withColumn("local", local)
        .join(quotas, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")))
        .withColumn("head_words", F.greatest(F.lit(0), F.least(
            F.col("local") + F.col("size"), F.col("first") * block - F.col("begin")) - F.col("local")))
        .withColumn("a", F.greatest(F.col("begin") + F.col("local") - F.col("first") * block, F.lit(0)))
        .withColumn("b", F.greatest(F.col("begin") + F.col("local") + F.col("size") - F.col("first") * block, F.lit(0)))
    )
    end = (F.col("turn") + F.col("rest")) * block
    ring = F.col("blocks") * block

    def inside(x: str) -> Column:
        """Words before x in the blocks of the rotation; past the ring's end it goes on at its beginning."""
        run = F.least(F.greatest(F.col(x) - F.col("turn") * block, F.lit(0)), F.col("rest") * block)
        return run + F.least(F.col(x), F.greatest(end - ring, F.lit(0)))

    taken = F.col("head") * F.col("head_words") + F.col("full") * (F.col("b") - F.col("a")) + inside("b") - inside("a")
    return at.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op8_sainte_lague_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
