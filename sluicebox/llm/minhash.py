"""Document fingerprints by MinHash.

Shingles of five words are hashed to 64 bits; PERMUTATIONS universal hashes
``a * x + b`` (mod 2^64) are taken of all shingles in vectorised numpy and the
least value of each is kept.  The share of equal positions of two fingerprints
estimates the Jaccard similarity of the shingle sets.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import parts, table, workspace
from sluicebox.llm.components import components

PERMUTATIONS = 128
SHINGLE = 5
BANDS = 32
SIMILAR = 0.8
#: Characters of text in a task, and the most ranges of ids.
TASK_CHARS = 4_000_000
RANGES = 4096
#: Characters hashed in one go.
GROUP_CHARS = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_RANDOM = np.random.default_rng(20240229)
_A = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        _powers = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))]) for base in (_BASE, _BASE_INVERSE))
    return _powers


def shingle_hashes(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles of all texts, and where each text's begin (one more entry at the end).

    A-Z count as a-z; a text of fewer words than ``size`` is one shingle, one without words has none.
    """
    ends = np.cumsum([len(t) + 1 for t in texts])
    buf = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    up, down = _powers_to(len(buf) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)], out=sums[1:])
        inside = ~_SPACE[buf]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        words = _mix((sums[stops] - sums[starts]) * down[starts])
        first = np.concatenate([[0], np.searchsorted(starts, ends)])
        count = np.diff(first)
        shingles = np.where(count >= size, count - size + 1, np.minimum(count, 1))
        begin = np.concatenate([[0], np.cumsum(shingles)])
        at = np.arange(begin[-1]) - np.repeat(begin[:-1], shingles) + np.repeat(first[:-1], shingles)
        short = np.repeat(np.where(count < size, count, size), shingles)
        out = short.astype(np.uint64)
        words = np.append(words, np.zeros(size, np.uint64))
        for k in range(size):
            out += np.where(k < short, words[at + k] * _PLACE[k], np.uint64(0))
        return _mix(out), begin


def signatures(texts: list[bytes]) -> np.ndarray:
    """A row of PERMUTATIONS 16-bit values for each text; texts without words have the greatest values."""
    hashes, begin = shingle_hashes(texts)
    out = np.full((len(texts), PERMUTATIONS), 0xFFFF, np.uint16)
    some = np.flatnonzero(np.diff(begin))
    if len(some):
        room = np.empty_like(hashes)
        with np.errstate(over="ignore"):
            for k in range(PERMUTATIONS):
                np.multiply(hashes, _A[k], out=room)
                np.add(room, _B[k], out=room)
                out[some, k] = np.minimum.reduceat(room, begin[some]) >> np.uint64(48)
    return out


def in_groups(texts: list[bytes]) -> np.ndarray:
    """``signatures`` in groups of bounded size."""
    done, group, size = [], [], 0
    for text in texts:
        if group and size + len(text) > GROUP_CHARS:
            done.append(signatures(group))
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        done.append(signatures(group))
    return np.concatenate(done) if done else np.zeros((0, PERMUTATIONS), np.uint16)


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, with the chance matches of 16-bit values taken off."""
    same = (left == right).mean(axis=-1)
    return np.clip((same - 2.0 ** -16) / (1 - 2.0 ** -16), 0.0, 1.0)


def hexed(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


# --- fingerprints of documents, of their edited texts, and of their neighbours

_EDIT_SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _pairs(batches: Iterator[pa.RecordBatch]):
    """(doc_id, text, text of the next document) in bounded lists; rows come sorted, a range's guest last."""
    held, pairs, size = None, [], 0
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("range", "guest", "doc_id", "text")]
        for at, guest, doc_id, text in zip(*columns):
            text = text or ""
            if held is not None and held[0] == at:
                pairs.append((held[1], held[2], text))
                size += len(held[2]) + len(text)
            held = None if guest else (at, doc_id, text)
            if size > GROUP_CHARS:
                yield pairs
                pairs, size = [], 0
    if pairs:
        yield pairs


def _fingerprint_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for pairs in _pairs(batches):
        # A document's next one is mostly the next pair's first text: hash each text once.
        own = [text.encode() for _, text, _ in pairs]
        edited, later, later_at = [], [], []
        for k, (_, text, after) in enumerate(pairs):
            half = len(text) // 2
            edited.append((text[:len(text) - half] + after[:half]).encode())
            if k + 1 == len(pairs) or pairs[k + 1][1] is not after:
                later.append(after.encode())
                later_at.append(k)
        marks, edited_marks = in_groups(own), in_groups(edited)
        next_marks = np.concatenate([marks[1:], marks[:1]])
        next_marks[later_at] = in_groups(later)
        near_edited, near_next = likeness(marks, edited_marks), likeness(marks, next_marks)
        yield pa.RecordBatch.from_arrays([
            pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(p[1]) for p in pairs], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array([hexed(m) for m in marks], pa.string()), pa.array([hexed(m) for m in edited_marks], pa.string()),
            pa.array(near_edited), pa.array(near_next)], schema=_ARROW)


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text replaces the last half of the code points by the first as
    many of the next document in descending doc_id; after the last comes the
    first, and a lone document follows itself.  One row per input row; null
    texts are empty; rows with equal doc_id follow each other by text; a null
    doc_id comes last.  An empty table gives no rows.  Only doc_id and text are
    read.  Ids are cut into ranges; each task sorts its range and streams it,
    and the first document of a range is also sent, as a guest, to the range before.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", "text", F.coalesce("doc_id", F.lit(-2 ** 63)).alias("rank"))
    total = rows.agg(F.sum(F.length("text"))).first()[0]
    wanted = min(RANGES, parts(total, TASK_CHARS))
    shares = [k / wanted for k in range(1, wanted)]
    bounds = sorted(set(rows.agg(F.percentile_approx("rank", F.array(*map(F.lit, shares)), 100_000)).first()[0] or [])) if shares else []
    # At most RANGES bounds; a larger id is in an earlier range.
    at = (F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b > F.col("rank"))) if bounds else F.lit(0))
    rows = rows.withColumn("range", at)
    firsts = sorted((r["range"], r["first"]) for r in rows.groupBy("range").agg(F.max("rank").alias("first")).collect())
    if not firsts:
        return spark.createDataFrame([], _EDIT_SCHEMA)
    hosts = [firsts[k - 1][0] for k in range(len(firsts))]
    guests = spark.createDataFrame([(first, host) for (_, first), host in zip(firsts, hosts)], "rank bigint, host int")
    # One row per range: at most RANGES rows.
    visiting = rows.drop("range").join(F.broadcast(guests), "rank").select(
        "doc_id", "text", "rank", F.col("host").alias("range"), F.lit(1).alias("guest"))
    home = rows.select("doc_id", "text", "rank", "range", F.lit(0).alias("guest"))
    ranged = home.unionByName(visiting).repartition(len(firsts), "range").sortWithinPartitions(
        "range", "guest", F.col("rank").desc(), F.coalesce("text", F.lit("")))
    return ranged.select("range", "guest", "doc_id", "text").mapInArrow(_fingerprint_edits, _EDIT_SCHEMA)


def op2_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


# --- similar documents

_SET_SCHEMA = "doc_id bigint, shingles array<bigint>, bands array<binary>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        sets, bands = [], []
        for text, signature in zip(texts, in_groups(texts)):
            own = np.unique(shingle_hashes([text])[0])
            sets.append(own.view(np.int64))
            bands.append([b.tobytes() for b in signature.reshape(BANDS, -1)] if len(own) else [])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.binary()))],
            names=["doc_id", "shingles", "bands"])


def similar_documents(documents: DataFrame, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class_id, component_id) of every document, and verified links (left, right, jaccard) between classes.

    A class is all documents with one shingle set, named by its smallest
    doc_id; documents without words are classes of their own.  Classes that
    share a band of the signature are compared with the smallest class of
    that bucket first, one pair per member; in a bucket that then still holds
    several components, each pair of classes of different ones is compared.  So
    the links join all that links of every pair in a bucket would join.  The
    component is the least doc_id that links reach.
    """
    work = workspace(documents)
    sets = documents.select("doc_id", "text").mapInArrow(_sets, _SET_SCHEMA)
    sets = work.stage(sets.withColumn("digest", F.when(
        F.size("shingles") > 0, F.sha2(F.array_join("shingles", ","), 256)).otherwise(F.col("doc_id").cast("string"))), "sets")
    classes = work.stage(sets.groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")
    members = sets.select("doc_id", "digest").join(classes, "digest").select("doc_id", "class_id")
    first = sets.join(classes.select(F.col("class_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    banded = work.stage(first.select("doc_id", F.size("shingles").alias("n"), F.posexplode("bands").alias("band", "part")), "banded")
    least = work.stage(banded.groupBy("band", "part").agg(F.min("doc_id").alias("left"), F.count("*").alias("m")).where("m > 1").drop("m"), "least")
    stars = work.stage(banded.join(least, ["band", "part"]).where("left < doc_id").select("left", F.col("doc_id").alias("right")).distinct(), "stars")
    own = work.stage(first.select("doc_id", "shingles").dropDuplicates(["doc_id"]), "own")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        return work.stage(
            pairs.join(own.toDF("left", "a"), "left").join(own.toDF("right", "b"), "right")
            .withColumn("both", F.size(F.array_intersect("a", "b")))
            .withColumn("jaccard", F.col("both") / (F.size("a") + F.size("b") - F.col("both")))
            .where(F.col("jaccard") >= similar).select("left", "right", "jaccard"), name)

    found = verified(stars, "first-links")
    joined = components(found, work, "first-components")
    labelled = work.stage(banded.join(joined, F.col("doc_id") == F.col("node"), "left").select(
        "band", "part", "doc_id", "n", F.coalesce("component", "doc_id").alias("component")), "labelled")
    mixed = labelled.groupBy("band", "part").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("band", "part")
    left = work.stage(labelled.join(mixed, ["band", "part"]), "open")
    right = left.toDF("band", "part", "right", "n_right", "component_right")
    # Sets whose sizes alone keep them apart are no pair.
    rest = left.withColumnRenamed("doc_id", "left").join(right, ["band", "part"]).where(
        (F.col("left") < F.col("right")) & (F.col("component") != F.col("component_right"))
        & (F.least("n", "n_right") / F.greatest("n", "n_right") >= similar)).select("left", "right").distinct()
    links = found.unionByName(verified(rest.join(stars, ["left", "right"], "left_anti"), "second-links"))
    labels = components(links, work, "components")
    members = members.join(labels, F.col("class_id") == F.col("node"), "left").select(
        "doc_id", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    return members, links
