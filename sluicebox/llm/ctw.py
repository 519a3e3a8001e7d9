"""Language-model scoring by context-tree weighting.

A text is coded as its tokens: the bytes of a word, then a space; at the end of
the text, a line feed.  Each byte is eight binary decisions.  A decision has a
context: the bits of its byte so far and the DEPTH bytes before it in the text,
those of earlier words included (before the text's first byte stand spaces).
Every context holds a Krichevsky-Trofimov estimate of its counts; a node's
weighted probability is half its own estimate and half the product of its
children's, so every prediction mixes the estimates of all depths.  A context
that the training texts never show leaves its share to its parent.

A byte's code length depends on its gram, the byte and its context.  Grams are
counted over the texts, and the tree is computed from them: its two upper levels
have at most 256 * 255 nodes; below them, contexts that end in the same two
bytes make one group.  Each task packs what is coded of its texts into chunks,
which are written once and read by every later pass; a chunk asks for each of its
grams and words once, in lists by bucket, and its texts add up the answers.  Only
compressed chunks meet the answers by a shuffle.  No table that grows with the
corpus is broadcast.
"""
from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import parts, table, workspace

DEPTH = 5
FOLDS = 5
HELD_OUT = 1
CHUNK_BYTES = 24_000_000
#: Bytes of text whose grams are made in one go.
GROUP_BYTES = 4_000_000
#: Grams that a task hands on at once; grams and words of a bucket.
HELD_GRAMS = 4_000_000
BUCKET_GRAMS = 40_000
SPACE, END = 0x20, 0x0A

_HALF = np.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for positive x, by Stirling's series after shifting x above 8."""
    x = np.asarray(x, float)
    shift = np.ones_like(x)
    z = x.copy()
    for _ in range(8):
        small = z < 8
        shift = np.where(small, shift * z, shift)
        z = np.where(small, z + 1, z)
    r = 1 / (z * z)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def kt_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def stream_of(tokens: list[bytes]) -> bytes:
    """What is coded of a text."""
    return b" ".join([*tokens, bytes([END])])


def grams_of(streams: list[bytes]) -> np.ndarray:
    """Context, most recent byte highest, and byte (lowest) of every byte of all streams."""
    pad = bytes([SPACE]) * DEPTH
    buf = np.frombuffer(b"".join(pad + s for s in streams), np.uint8).astype(np.int64)
    grams = buf[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        grams |= buf[DEPTH - k:len(buf) - k] << (8 * (DEPTH - k + 1))
    sizes = np.full(2 * len(streams), DEPTH)
    sizes[::2] = [len(s) for s in streams]
    return grams[np.repeat(np.tile([True, False], len(streams)), sizes)[:len(grams)]]


def in_groups(items: list, size) -> list[list]:
    """Runs of items of about GROUP_BYTES bytes."""
    groups, room = [], 0
    for item in items:
        if not groups or room + size(item) > GROUP_BYTES:
            groups.append([])
            room = 0
        groups[-1].append(item)
        room += size(item)
    return groups


def _nodes(context: np.ndarray, byte: np.ndarray, depth: int) -> np.ndarray:
    """Node names (rows x 8): context of ``depth`` bytes, then a one and the bits before each decision."""
    shorter = context >> (8 * (DEPTH - depth))
    bits = np.stack([(1 << k) | (byte >> (8 - k)) for k in range(8)], axis=1)
    return shorter[:, None] << 8 | bits


def _bits(byte: np.ndarray) -> np.ndarray:
    return np.stack([(byte >> (7 - k)) & 1 for k in range(8)], axis=1)


class Subtree:
    """The nodes of depths ``top`` .. DEPTH over the given grams, with weights from the leaves up."""

    def __init__(self, context, byte, count, top):
        self.top, self.bits, self.levels = top, _bits(byte), []
        weight = np.repeat(count.astype(float), 8)
        ones = self.bits.ravel() == 1
        child = None
        for depth in range(DEPTH, top - 1, -1):
            names, index = np.unique(_nodes(context, byte, depth).ravel(), return_inverse=True)
            n1 = np.bincount(index, weights=weight * ones, minlength=len(names))
            n0 = np.bincount(index, weights=weight * ~ones, minlength=len(names))
            estimate = kt_block(n0, n1)
            if child is None:
                weighted = estimate
            else:
                below = np.zeros(len(names))
                parent = np.empty(len(child[0]), np.int64)
                parent[child[1]] = index
                np.add.at(below, parent, child[0])
                weighted = np.logaddexp(_HALF + estimate, _HALF + below)
            stop = np.ones(len(names)) if child is None else np.exp(_HALF + estimate - weighted)
            self.levels.insert(0, (names, index, n0, n1, weighted, stop))
            child = (weighted, index)

    def log10(self, mixed: np.ndarray, open_share: np.ndarray, last: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's byte.

        Of each decision come in, from the levels above ``top``: the part of the
        probability of a one that is settled, the share that is still open, and
        the probability if nothing deeper is known.
        """
        p = last
        for names, index, n0, n1, _, stop in self.levels:
            a, b, s = (v[index].reshape(-1, 8) for v in (n0, n1, stop))
            seen = (a + b) > 0
            one = (b + 0.5) / (a + b + 1)
            p = np.where(seen, mixed + open_share * one, p)
            mixed = np.where(seen, mixed + open_share * s * one, mixed)
            open_share = np.where(seen, open_share * (1 - s), open_share)
        return np.log10(np.where(self.bits == 1, p, 1 - p)).sum(axis=1)


class Upper:
    """Depths 0 and 1 of the tree, from the node rows of depth 1 (at most 256 * 255)."""

    def __init__(self, names, n0, n1, below):
        estimate = kt_block(n0, n1)
        weighted = np.logaddexp(_HALF + estimate, _HALF + below)
        self.stop1 = np.exp(_HALF + estimate - weighted)
        self.names, self.n0, self.n1 = names, n0, n1
        self.root0 = np.bincount(names & 255, weights=n0, minlength=256)
        self.root1 = np.bincount(names & 255, weights=n1, minlength=256)
        root = kt_block(self.root0, self.root1)
        self.stop0 = np.exp(_HALF + root - np.logaddexp(_HALF + root, _HALF + np.bincount(names & 255, weights=weighted, minlength=256)))

    def enter(self, context: np.ndarray, byte: np.ndarray):
        """What ``Subtree.log10`` takes of the levels above."""
        node = _nodes(context, byte, 1)
        bits = node & 255
        seen = (self.root0 + self.root1)[bits] > 0
        one = (self.root1[bits] + 0.5) / (self.root0[bits] + self.root1[bits] + 1)
        last = np.where(seen, one, 0.5)
        mixed = np.where(seen, self.stop0[bits] * one, 0.0)
        share = np.where(seen, 1 - self.stop0[bits], 1.0)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, node), len(self.names) - 1)
            a, b = self.n0[at], self.n1[at]
            seen = (self.names[at] == node) & (a + b > 0)
            one = (b + 0.5) / (a + b + 1)
            stop = self.stop1[at]
            last = np.where(seen, mixed + share * one, last)
            mixed = np.where(seen, mixed + share * stop * one, mixed)
            share = np.where(seen, share * (1 - stop), share)
        return mixed, share, last


# --- tasks

def tokens_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, split at ASCII white space."""
    return (text or "").encode().lower().split()


_CHUNKS = "chunk bigint, doc_id array<bigint>, held_out array<boolean>, packed binary"
_CHUNKS_ARROW = pa.schema([("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("packed", pa.binary())])
#: Chunks of one task, at most.
_TASK_CHUNKS = 1 << 24


def _pack(chunk_bytes):
    """What is coded of a task's texts, in chunks: one compressed string each, as a line feed ends every text and stands nowhere else."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        first = TaskContext.get().partitionId() * _TASK_CHUNKS
        ids, outs, streams, room, made = [], [], [], 0, 0

        def chunk():
            packed = packer.compress(b"".join(streams))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((first + made, ids, outs, packed), _CHUNKS_ARROW)], schema=_CHUNKS_ARROW)

        for batch in batches:
            for doc_id, held_out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text")):
                stream = stream_of(tokens_of(text.as_py()))
                if streams and room + len(stream) > chunk_bytes:
                    yield chunk()
                    ids, outs, streams, room, made = [], [], [], 0, made + 1
                ids.append(doc_id)
                outs.append(held_out)
                streams.append(stream)
                room += len(stream)
        if streams:
            yield chunk()
    return run


def _streams(packed) -> list[bytes]:
    """The texts of a chunk, as they are coded."""
    return [line + bytes([END]) for line in zstandard.ZstdDecompressor().decompress(packed.as_py())[:-1].split(bytes([END]))]


def _count_words(batches):
    """Distinct words of each chunk with their number in training texts."""
    for batch in batches:
        for outs, packed in zip(batch.column("held_out").to_pylist(), batch.column("packed")):
            counts: Counter[bytes] = Counter()
            for stream, held_out in zip(_streams(packed), outs):
                words = stream.split()
                if held_out:
                    for word in words:
                        counts.setdefault(word, 0)
                else:
                    counts.update(words)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def _added(names: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each name once, with the sum of its numbers."""
    by = np.argsort(names, kind="stable")
    names, n = names[by], n[by]
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, np.int64)
    return names[first], np.add.reduceat(n, first) if len(first) else n


def _count_grams(batches):
    """Grams of a task's texts with their number in training texts."""
    names, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for outs, packed in zip(batch.column("held_out").to_pylist(), batch.column("packed")):
            listed = list(zip(_streams(packed), outs))
            for out in (False, True):
                for group in in_groups([s for s, o in listed if o == out], len):
                    own, count = np.unique(grams_of(group), return_counts=True)
                    names, n = _added(np.concatenate([names, own]), np.concatenate([n, 0 * count if out else count]))
                    if len(names) > HELD_GRAMS:
                        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n)], names=["gram", "n"])
                        names, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n)], names=["gram", "n"])


def _split(rows: pa.Table):
    gram = rows.column("gram").to_numpy()
    return gram >> 8, gram & 255, rows.column("n").to_numpy()


def _weigh(rows: pa.Table) -> pa.Table:
    """The depth-2 nodes of a group with their counts and weighted probability, as children of depth 1."""
    names, _, n0, n1, weighted, _ = Subtree(*_split(rows), 2).levels[0]
    # Depth-1 name: the most recent byte and the bits.
    parent = (names >> 16) << 8 | (names & 255)
    return pa.Table.from_arrays([pa.array(v) for v in (parent, n0, n1, weighted)], names=["node", "n0", "n1", "weighted"])


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def _log10(upper: Upper, buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        context, byte, n = _split(rows)
        scores = Subtree(context, byte, n, 2).log10(*upper.enter(context, byte))
        gram = rows.column("gram").to_numpy()
        return pa.Table.from_arrays([pa.array(_bucket(gram, buckets).astype(np.int32)), pa.array(gram), pa.array(scores)],
                                    names=["bucket", "gram", "log10"])
    return run


_WANTED = "chunk bigint, bucket int, grams binary, words array<binary>"


def _chunk_wanted(buckets: int):
    """The distinct grams and words of each chunk, a row for each bucket."""
    def wanted(chunk: int, packed) -> pa.RecordBatch:
        words, grams = {bytes([END])}, np.zeros(0, np.int64)
        for group in in_groups(_streams(packed), len):
            for stream in group:
                words.update(stream.split())
            grams = np.union1d(grams, grams_of(group))
        at = _bucket(grams, buckets)
        by = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[by], np.arange(buckets + 1))
        listed = [[] for _ in range(buckets)]
        for word in words:
            listed[zlib.crc32(word) % buckets].append(word)
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * buckets, pa.int64()), pa.array(range(buckets), pa.int32()),
             pa.array([grams[by[edges[k]:edges[k + 1]]].tobytes() for k in range(buckets)], pa.binary()),
             pa.array(listed, pa.list_(pa.binary()))], names=["chunk", "bucket", "grams", "words"])

    def run(batches):
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("packed")):
                yield wanted(chunk, packed)
    return run


_ANSWERS = "chunk bigint, grams binary, logs binary, words array<binary>, numbers binary"


def _answer(wanted: pa.Table, known: pa.Table) -> pa.Table:
    """The predictions and counts that each chunk wants of a bucket."""
    is_word = known.column("word").is_valid()
    predicted, vocabulary = known.filter(pc.invert(is_word)), known.filter(is_word)
    names, logs = predicted.column("gram").to_numpy(), predicted.column("log10").to_numpy()
    by = np.argsort(names)
    names, logs = names[by], logs[by]
    number = dict(zip(vocabulary.column("word").to_pylist(), vocabulary.column("n").to_pylist()))
    scores, numbers = [], []
    for grams, words in zip(wanted.column("grams"), wanted.column("words")):
        asked = np.frombuffer(grams.as_py(), np.int64)
        at = np.searchsorted(names, asked)
        if not (names[at] == asked).all():
            raise ValueError("a gram has no prediction")
        scores.append(logs[at].tobytes())
        numbers.append(np.array([number[w] for w in words.as_py()], np.int64).tobytes())
    return pa.Table.from_arrays(
        [wanted.column("chunk"), wanted.column("grams"), pa.array(scores, pa.binary()), wanted.column("words"), pa.array(numbers, pa.binary())],
        names=["chunk", "grams", "logs", "words", "numbers"])


class Places:
    """Finds grams among known ones: a slot for most, a binary search for those whose slot is another's."""

    def __init__(self, names: np.ndarray, values: np.ndarray):
        by = np.argsort(names)
        self.names, self.values = names[by], values[by]
        self.shift = np.uint64(64 - max(1, int(len(names) * 2).bit_length()))
        slot = self._slot(self.names)
        self.keys = np.full(1 << int(np.uint64(64) - self.shift), -1, np.int64)
        self.held = np.zeros(len(self.keys))
        self.keys[slot] = self.names
        self.held[slot] = self.values

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def of(self, grams: np.ndarray) -> np.ndarray:
        slot = self._slot(grams)
        out = self.held[slot]
        other = np.flatnonzero(self.keys[slot] != grams)
        out[other] = self.values[np.searchsorted(self.names, grams[other])]
        return out


_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, "
           "n_bytes bigint, bits_per_byte double")


def _score_texts(total: int, distinct: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        whole = lambda name, kind: np.frombuffer(b"".join(answers.column(name).to_pylist()), kind)
        places = Places(whole("grams", np.int64), whole("logs", np.float64))
        words = [w for listed in answers.column("words").to_pylist() for w in listed]
        place, n = dict(zip(words, range(len(words)))), whole("numbers", np.int64)
        base = np.log10((n + 0.5) / (total + 0.5 * (distinct + 1)))
        end = place[bytes([END])]
        rows = []
        given = list(zip(chunk.column("doc_id")[0].as_py(), chunk.column("held_out")[0].as_py(), _streams(chunk.column("packed")[0])))
        for group in in_groups(given, lambda r: len(r[2])):
            streams = [stream for _, _, stream in group]
            begin = np.cumsum([0, *map(len, streams)])[:-1]
            scores = np.add.reduceat(places.of(grams_of(streams)), begin)
            for (doc_id, held_out, stream), score in zip(group, scores.tolist()):
                tokens = stream.split()
                at = np.append(np.fromiter((place[t] for t in tokens), np.int64, len(tokens)), end)
                rows.append((doc_id, held_out, len(at), int((n[at] > 0).sum()), total, float(base[at].sum()), score,
                             len(stream), -score / np.log10(2.0) / len(stream)))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64()]
        names = [p.split()[0] for p in _SCORES.split(", ")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    return run


# --- the operator

def score_texts(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte; a row per input row.

    score is the model's log10 probability of the text's tokens in their order, base_score
    that of smoothed word counts; n_bytes and bits_per_byte give the code
    length.  Null and empty texts consist of their end.  A null doc_id is not
    held out.  Repeated rows are texts of their own, in training too.  Without
    training texts every decision is even.  An empty table gives no rows.
    Only doc_id and text are read.
    """
    spark = documents.sparkSession
    work = workspace(documents)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False)).alias("held_out")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out, "text")
    ends = rows.agg(F.sum((~F.col("held_out")).cast("long")).alias("ends")).first()["ends"]
    if ends is None:
        return spark.createDataFrame([], _SCORES)
    # Each pass reads the written chunks; a chunk's number is part of what is written, so it does not depend on how they are read.
    chunks = work.stage(rows.mapInArrow(_pack(CHUNK_BYTES), _CHUNKS), "chunks")

    counted = chunks.select("held_out", "packed").mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    ending = spark.createDataFrame([(bytearray([END]), ends)], "word binary, n bigint")
    words = work.stage(counted.unionByName(ending), "words")
    known = words.agg(F.sum("n").alias("total"), F.sum((F.col("n") > 0).cast("long")).alias("distinct"), F.count("*").alias("words")).first()

    # Unseen grams of held-out texts ride along with count 0, so that each has its prediction.
    grams = work.stage(chunks.select("held_out", "packed").mapInArrow(_count_grams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    buckets = parts(grams.count() + known["words"], BUCKET_GRAMS)
    recent = F.shiftright("gram", 8 * (DEPTH - 1)).alias("recent")  # the last two bytes before the decision
    grouped = grams.groupBy(recent)
    below = grouped.applyInArrow(_weigh, "node bigint, n0 double, n1 double, weighted double").groupBy("node").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("below")).orderBy("node").toArrow()
    upper = Upper(*[below.column(c).to_numpy() for c in ("node", "n0", "n1", "below")])
    predicted = grouped.applyInArrow(_log10(upper, buckets), "bucket int, gram bigint, log10 double")
    vocabulary = words.select((F.crc32("word") % buckets).cast("int").alias("bucket"), "word", "n")
    answers = work.stage(predicted.unionByName(vocabulary, allowMissingColumns=True), "answers")

    wanted = chunks.select("chunk", "packed").mapInArrow(_chunk_wanted(buckets), _WANTED)
    answered = wanted.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_answer, _ANSWERS)
    return chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(_score_texts(known["total"], known["distinct"]), _SCORES)


def op1_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
