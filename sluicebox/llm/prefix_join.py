"""N-gram Jaccard join with prefix filters under several global orders.

Two sets whose Jaccard similarity reaches the threshold share, under every
total order of the tokens, one of the first ``n - least overlap + 1`` tokens.
The first order puts rare tokens first: it ranks the tokens with the least
hashes (one and a half times the share of a prefix) by document count, and all others
after them by hash, so counts are needed of that share only.  Tokens that occur
once fill prefixes without ever making a candidate.  The other orders are
permutations by multiplication.  A pair must pass the filters of all orders
before its sets are compared.  Ahead of that, while pairs are joined, a bitmap of
each set (the parity of its tokens in BITS places) bounds their difference from
below, so that pairs that only resemble each other are never written.

Documents with equal sets are one class, and tokens that the same classes have
are one group.  In each round the members of a group are compared with one of
them, its pivot, and components are built from the links found; groups within
one component are done.  What is still mixed after some rounds is
compared pair by pair between components, so that no link that joins components
is lost, while a group of near copies costs some comparisons per member.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import table, workspace
from sluicebox.llm.components import components
from sluicebox.llm.minhash import shingle_hashes
from sluicebox.plans.workspace import Workspace

SHINGLE = 3
PERCENT = 90
#: Seeds of pivots that take turns over the groups of a round, and rounds at most before pairs are compared.
PIVOTS = 4
ROUNDS = 3
#: Groups of a class that its rows tell, the least ones, so that a pair need not be met in each group it shares.
SHOWN = 24
#: A table of at most so many rows of two numbers (16 MB) may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000

#: Width of the bitmaps.
BITS = 1024
_PLACE = np.uint64(0x8CB92BA72F3D8DD7)
_ORDERS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a prefix: n - ceil(percent * n / 100) + 1."""
    return n - (-(-percent * n // 100)) + 1


def counted_below(percent: int) -> np.uint64:
    """Hashes below this are counted: one and a half times the share of a prefix, so that its tokens can be chosen for being rare."""
    return np.uint64(min(int((100 - percent) * 3 / 200 * 2 ** 64), 2 ** 64 - 1))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time, as their sets take more room than their texts."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = [(t or "").encode() for t in texts]
    at = 0
    while at < len(raw):
        end, amount = at, 0
        while end < len(raw) and (end == at or amount + len(raw[end]) <= 500_000):
            amount += len(raw[end])
            end += 1
        hashes, begin = shingle_hashes(raw[at:end], size)
        for k in range(end - at):
            yield np.unique(hashes[begin[k]:begin[k + 1]])
        at = end


def _bitmap(tokens: np.ndarray) -> np.ndarray:
    """Parity of the tokens in each of BITS places; two sets differ in at least as many tokens as their bitmaps in bits."""
    with np.errstate(over="ignore"):
        places = ((tokens * _PLACE) >> np.uint64(40)).astype(np.int64) % BITS
    return np.packbits((np.bincount(places, minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def _class(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


_MARKS = "row string, doc_id bigint, n bigint, class binary, counted int, pool array<bigint>, bits array<bigint>"


def _marks(size: int, percent: int):
    """Each document's set: its size, its class, and the tokens that can be in its first prefix."""
    below = counted_below(percent)

    def run(batches):
        for batch in in_slices(batches):
            n, classes, counted, pools, bits = [], [], [], [], []
            for tokens in _sets(batch.column("text").to_pylist(), size):
                low = int(np.searchsorted(tokens, below))
                n.append(len(tokens))
                classes.append(_class(tokens))
                counted.append(low)
                bits.append(_bitmap(tokens))
                pools.append(tokens[:max(low, prefix_length(len(tokens), percent))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(counted, pa.int32()), _lists(pools), _lists(bits)], names=["row", "doc_id", "n", "class", "counted", "pool", "bits"])
    return run


_FULL = "class binary, tokens array<bigint>, orders array<array<bigint>>"


def _full(size: int, percent: int):
    """Whole sets, and their prefixes under the orders after the first."""
    def run(batches):
        for batch in in_slices(batches):
            classes, sets, orders = [], [], []
            for tokens in _sets(batch.column("text").to_pylist(), size):
                classes.append(_class(tokens))
                sets.append(tokens)
                length = prefix_length(len(tokens), percent)
                with np.errstate(over="ignore"):
                    orders.append([tokens[np.argsort(tokens * order, kind="stable")[:length]].view(np.int64) for order in _ORDERS])
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.binary()), _lists(sets), pa.array(orders, pa.list_(pa.list_(pa.int64())))],
                names=["class", "tokens", "orders"])
    return run


def _row() -> Column:
    """Names a row by its doc_id and text; never null."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))


def _close(percent: int) -> Column:
    """Sizes and bitmaps of a and b allow the similarity: (100 - percent)(n + n') >= (100 + percent) * difference."""
    apart = F.lit(0)
    for k in range(BITS // 64):
        apart = apart + F.bit_count(F.col("bits_a")[k].bitwiseXOR(F.col("bits_b")[k]))
    n_a, n_b = F.col("n_a"), F.col("n_b")
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & ((100 + percent) * apart <= (100 - percent) * (n_a + n_b))


def _groups(pools: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """token, id, n, bits of the classes that have the token in their first prefix; groups of the same classes are one."""
    tokens = pools.select("id", "n", "counted", F.explode("pool").alias("token"))
    # Tokens that at least two classes have; the others cannot make a candidate.
    repeated = work.stage(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "repeated")
    own = tokens.join(repeated, "token").groupBy("id", "n", "counted").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    # Unsigned order of hashes in signed numbers.
    below = int(np.array([counted_below(percent)], np.uint64).view(np.int64)[0])
    low = lambda s: ((s["token"] >= 0) & (s["token"] < F.lit(below))) if below > 0 else ((s["token"] >= 0) | (s["token"] < F.lit(below)))
    n, counted = F.col("n"), F.col("counted")
    length = n - F.ceil(percent * n / 100) + 1
    ranked = own.withColumn("low", F.array_sort(F.filter("shared", low))).withColumn("high", F.filter("shared", lambda s: ~low(s))).withColumn(
        "room", F.greatest(F.lit(0), length - (counted - F.size("low"))).cast("int"))
    prefixes = work.stage(
        ranked.select("id", "n", F.explode(F.concat(F.slice("low", F.lit(1), F.col("room")), F.when(
            length > counted, F.col("high")).otherwise(F.array().cast("array<struct<df:bigint,token:bigint>>")))).alias("s"))
        .select("id", "n", "s.token"), "prefixes")
    # Shared passages and families of copies give many tokens with the same classes.
    signature = [F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y")]
    chosen = prefixes.groupBy("token").agg(*signature).where("m > 1").groupBy("m", "x", "y").agg(F.min("token").alias("kept"))
    members = prefixes.join(chosen.select("kept"), F.col("token") == F.col("kept")).drop("kept")
    return work.stage(members.join(pools.select("id", "bits"), "id").select("token", "id", "n", "bits"), "members")


def _classified(documents: DataFrame, size: int, percent: int, work: Workspace) -> DataFrame:
    """row, doc_id, n, least_id, component of every row; the last two are null without words, least_id also without ids."""
    marks = documents.select(_row().alias("row"), "doc_id", "text").mapInArrow(_marks(size, percent), _MARKS)
    marks = work.stage(marks.withColumn("at", F.monotonically_increasing_id()), "marks")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "at", "row")).alias("first")
    classes = work.stage(marks.where("n > 0").groupBy("class").agg(first).select("class", "first.doc_id", "first.at", "first.row"), "classes")
    # A class goes by the number of its first row.
    pools = marks.join(classes.select("at"), "at").select(F.col("at").alias("id"), "n", "counted", "pool", "bits")
    members = _groups(pools, percent, work)

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (left, right) that pass the other orders and then the comparison of their sets."""
        involved = pairs.select(F.col("left").alias("at")).union(pairs.select("right")).distinct()
        near = work.stage(involved.join(classes, "at").select("class", F.col("at").alias("id"), F.col("row").alias("wanted")), f"{name}-near")
        wanted = near.select("wanted")
        chosen = F.broadcast(wanted) if near.count() <= BROADCAST_ROWS else wanted
        texts = documents.select(_row().alias("row"), "text").join(chosen, F.col("row") == F.col("wanted"), "left_semi")
        full = texts.mapInArrow(_full(size, percent), _FULL).join(near.select("class", "id"), "class")
        sets = work.stage(full.dropDuplicates(["id"]).select("id", "tokens", "orders"), f"{name}-sets")
        orders = sets.select("id", "orders")
        passed = pairs.join(orders.toDF("left", "a"), "left").join(orders.toDF("right", "b"), "right")
        for k in range(len(_ORDERS)):
            passed = passed.where(F.arrays_overlap(F.col("a")[k], F.col("b")[k]))
        passed = work.stage(passed.select("left", "right"), f"{name}-passed")
        whole = sets.select("id", "tokens")
        both = F.size(F.array_intersect("a", "b"))
        return work.stage(
            passed.join(whole.toDF("left", "a"), "left").join(whole.toDF("right", "b"), "right")
            .withColumn("both", both).where(100 * F.col("both") >= percent * (F.size("a") + F.size("b") - F.col("both")))
            .select("left", "right"), f"{name}-links")

    def still_open(labels: DataFrame | None, name: str) -> DataFrame:
        """The members of groups that hold several components."""
        if labels is None:
            return members.withColumn("component", F.col("id"))
        labelled = work.stage(members.join(labels, F.col("id") == F.col("node"), "left").select(
            "token", "id", "n", "bits", F.coalesce("component", "id").alias("component")), f"{name}-labelled")
        mixed = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
        return labelled.join(mixed.select(F.col("token").alias("several")), F.col("token") == F.col("several")).drop("several")

    def sided(rows: DataFrame, side: str, *more: str) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"{c}_{side}") for c in ("token", "id", "n", "bits", "component", *more)])

    same_group = (F.col("token_a") == F.col("token_b")) & (F.col("component_a") != F.col("component_b")) & _close(percent)
    pair = [F.least("id_a", "id_b").alias("left"), F.greatest("id_a", "id_b").alias("right")]
    links, labels = None, None
    for k in range(ROUNDS):
        rows = still_open(labels, f"round-{k}")
        # The least by a seeded hash: groups that overlap have the same pivot, so a pair is met once and not once a token.
        seed = F.pmod("token", F.lit(PIVOTS)) + k * PIVOTS
        pivots = rows.groupBy("token").agg(F.min(F.struct(F.xxhash64("id", seed).alias("h"), "id")).alias("p")).select(
            F.col("token").alias("at"), F.col("p.id").alias("pivot"))
        chosen = rows.join(pivots, (F.col("token") == F.col("at")) & (F.col("id") == F.col("pivot"))).drop("at", "pivot")
        stars = work.stage(sided(rows, "a").join(sided(chosen, "b"), same_group).select(*pair).distinct(), f"round-{k}-stars")
        if stars.isEmpty():
            continue
        found = linked(stars, f"round-{k}")
        if found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        labels = components(links, work, f"round-{k}-components")

    rows = work.stage(still_open(labels, "rest"), "rest-open")
    shown = rows.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("token")), 1, SHOWN).alias("shown"))
    rows = work.stage(rows.join(shown, "id"), "rest-shown")
    # A pair is left to the least group that it is seen to share; where none is seen below this one, it is met here.
    earlier = lambda side: F.filter(F.col(f"shown_{side}"), lambda t: t < F.col("token_a"))
    met = (F.col("id_a") < F.col("id_b")) & same_group & ~F.arrays_overlap(earlier("a"), F.col("shown_b"))
    rest = work.stage(sided(rows, "a", "shown").join(sided(rows, "b", "shown"), met).select(*pair).distinct(), "rest")
    if not rest.isEmpty():
        found = linked(rest, "rest")
        links = found if links is None else links.unionByName(found)
        labels = components(links, work, "rest-components")

    named = classes.select("class", "doc_id", F.col("at").alias("id"))
    if labels is None:
        named = named.withColumn("component", F.col("id"))
    else:
        named = named.join(labels, F.col("id") == F.col("node"), "left").select("class", "doc_id", F.coalesce("component", "id").alias("component"))
    ids = named.groupBy("component").agg(F.min("doc_id").alias("least_id"))
    named = work.stage(named.join(ids, "component").select(F.col("class").alias("c"), "least_id", "component"), "named")
    return marks.select("row", "doc_id", "n", "class").join(named, F.col("class") == F.col("c"), "left").select(
        "row", "doc_id", "n", "least_id", "component")


def similar_components(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id reachable by links of similarity >= percent / 100.

    One row per input row.  Null texts and texts without words have an empty
    set and are linked with nothing.  Copies share a component.  Rows that
    repeat a doc_id with other texts are sets of their own.  A null doc_id
    counts as no id: its component is that of the others.  An empty table
    gives no rows.  Only doc_id and text are read.
    """
    rows = _classified(documents, size, percent, workspace(documents))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one_per_component(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, all columns: that of the least doc_id (rows without one come last).

    Rows are told apart by doc_id and text, so a row with another's doc_id, or without any, goes only if its own text is
    linked with that of the row that stays.  Of rows that are alike in both, any one stays.  Rows with null texts or texts without words
    stay, all of them.  An empty table gives no rows.  Columns may have any names.
    """
    work = workspace(documents)
    rows = work.stage(_classified(documents, size, percent, work).where("n > 0").select("row", "doc_id", "component"), "rows")
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best"))
    judged = rows.join(best.select(F.col("component").alias("c"), F.col("best.row").alias("kept")), F.col("component") == F.col("c"))
    counts = work.stage(judged.groupBy(F.col("row").alias("judged_row"), (F.col("row") == F.col("kept")).alias("stays")).agg(F.count("*").alias("times")), "judged")
    name = "judged_row"
    while name in documents.columns:
        name += "_"
    keyed = documents.withColumn(name, _row())

    def only(which: str, how: str) -> DataFrame:
        rows = counts.where(which).select(F.col("judged_row").alias("other"))
        return keyed.join(rows, F.col(name) == F.col("other"), how)

    alone = only("NOT stays OR times > 1", "left_anti")
    if not counts.where("stays AND times > 1").isEmpty():
        alone = alone.unionByName(only("stays AND times > 1", "left_semi").dropDuplicates([name]))
    return alone.select(*documents.columns)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))
