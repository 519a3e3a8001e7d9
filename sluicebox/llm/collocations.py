"""Phrase collocations by marginalising the counts of the longest windows.

Only windows of the top order are counted: at every word, the word and the
columns of the words that lead it, padded where the piece ends.  A count of a
shorter phrase is the sum over all windows that begin with it, and Spark's
ROLLUP over the window's columns sums these, down to the words and the
language; no n-gram of another order is ever written out.

Windows are counted in two steps, inside each task's chunk of text and then
per bucket of their first two words, so that all windows of a phrase of two or
more words meet in one bucket.  There a window is padded down to the longest
prefix that occurs often enough to be a phrase: the rest counts for its prefixes
only, and the rollup moves few rows.
"""
from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicebox.llm.common import parts, table, workspace

#: Words of the longest phrase.
ORDER = 3
MIN_COUNT = 10
#: A candidate goes if a longer one around it is at least so many percent as frequent.
PERCENT = 50
TOP = 2000
SCALE = 1_000_000
#: Bytes of text whose windows a task counts before it sends them on.
CHUNK_BYTES = 8_000_000
#: Bytes of text whose windows meet in one bucket; the number of buckets grows with the corpus.
BUCKET_BYTES = 4_000_000
#: Candidates that are ranked in one task before the languages' best are ranked.
RANKED = 1_000_000

#: Bytes of a text whose words are objects at a time.
SLICE_BYTES = 1_000_000

_END = b"\n"
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class _Words:
    """The ids of one language's words in a chunk; 0 ends a piece."""

    def __init__(self, tail: list[bytes]):
        self.index: defaultdict[bytes, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.index[_END]
        self.ids = [np.array([self.index[w] for w in tail], np.int64)]

    def add(self, text: bytes, slice_bytes: int) -> None:
        """Numbers of the text's words, taken in slices that end at white space, so that few words are objects at a time."""
        data, at = text.lower().translate(_TABLE) + _END, 0
        while at < len(data):
            end = data.find(b" ", at + slice_bytes)
            end = len(data) if end < 0 else end
            found = [w for w in data[at:end].replace(_END, b" \n ").split(b" ") if w]
            self.ids.append(np.fromiter(map(self.index.__getitem__, found), np.int64, len(found)))
            at = end

    def windows(self, order: int, last: bool) -> tuple[list[np.ndarray], np.ndarray, list[bytes]]:
        """Distinct windows as columns of ids, their counts, and the words whose windows the next chunk completes."""
        ids = np.concatenate(self.ids)
        vocabulary = list(self.index)
        starts = len(ids) if last else max(len(ids) - order + 1, 0)
        tail = [vocabulary[k] for k in ids[starts:]]
        padded = np.concatenate([ids, np.zeros(order, np.int64)])
        columns = [padded[:starts]]
        for lead in range(1, order):
            columns.append(np.where(columns[-1] > 0, padded[lead:lead + starts], 0))
        some = columns[0] > 0
        columns = [c[some] for c in columns]
        key = columns[0]
        for column in columns[1:]:
            # Prefixes get new numbers from step to step, so no product leaves 64 bits.
            key = np.unique(key, return_inverse=True)[1] * len(vocabulary) + column
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        return [c[first] for c in columns], counts, tail


_CHUNKS = "lang string, bucket bigint, windows binary"


def _chunks(order: int, buckets: int):
    """Counted windows of each chunk: a row for each language and bucket that has some, a line for each window."""
    def send(lang: str | None, words: _Words, last: bool) -> tuple[pa.RecordBatch, list[bytes]]:
        columns, counts, tail = words.windows(order, last)
        hashes = np.fromiter(map(zlib.crc32, words.index), np.uint64, len(words.index))
        with np.errstate(over="ignore"):
            mixed = hashes[columns[0]] * _MIX[0] + hashes[columns[1]] * _MIX[1]
            bucket = ((mixed ^ (mixed >> np.uint64(31))) * _MIX[0] >> np.uint64(11)) % np.uint64(buckets)
        sort = np.argsort(bucket, kind="stable")
        bucket = bucket[sort].astype(np.int64)
        texts = pa.array([b"", *list(words.index)[1:]], pa.binary())
        lines = pc.binary_join_element_wise(
            *[texts.take(pa.array(c[sort])) for c in columns], pa.array(counts[sort]).cast(pa.string()).cast(pa.binary()), b"\t")
        begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
        offsets = np.concatenate([begin, [len(bucket)]]).astype(np.int32)
        blobs = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), b"\n")
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(begin), pa.string()), pa.array(bucket[begin]), blobs], names=["lang", "bucket", "windows"]), tail

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_words: dict[str, _Words] = {}
        amount = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                raw = (text.as_py() or "").encode()
                if lang not in open_words:
                    open_words[lang] = _Words([])
                open_words[lang].add(raw, SLICE_BYTES)
                amount += len(raw)
                if amount >= CHUNK_BYTES:
                    for name, words in open_words.items():
                        rows, tail = send(name, words, last=False)
                        open_words[name] = _Words(tail)
                        yield rows
                    amount = 0
        for name, words in open_words.items():
            yield send(name, words, last=True)[0]
    return run


def _count(order: int, least: int):
    """Exact counts of a bucket's windows, each padded down to its longest prefix of two or more words that ``least`` windows begin with."""
    names = [f"w{k + 1}" for k in range(order)]
    options = dict(
        parse_options=pa.csv.ParseOptions(delimiter="\t", quote_char=False, double_quote=False),
        convert_options=pa.csv.ConvertOptions(column_types={**dict.fromkeys(names, pa.binary()), "n": pa.int64()}, strings_can_be_null=False))

    def total(rows: pa.Table, keys: list[str]) -> pa.Table:
        return rows.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])

    def run(group: pa.Table) -> pa.Table:
        lang = group.column("lang")[0].as_py()
        data = b"\n".join(group.column("windows").to_pylist())
        # One block, as a line may be of any length.
        reading = pa.csv.ReadOptions(column_names=[*names, "n"], use_threads=False, block_size=min(len(data) + 1, 2 ** 31 - 1))
        rows = total(pyarrow.csv.read_csv(pa.BufferReader(data), read_options=reading, **options), names)
        del data
        for size in range(order, 1, -1):
            seen = total(rows, names[:size]).rename_columns([*names[:size], "seen"])
            rows = rows.join(seen, names[:size], use_threads=False)
            often = pc.greater_equal(rows.column("seen"), least)
            for name in names[size - 1:]:
                rows = rows.set_column(rows.column_names.index(name), name, pc.if_else(often, rows.column(name), pa.scalar(b"")))
            rows = total(rows, names)
        columns = [rows.column(c).combine_chunks().cast(pa.string()) for c in names]
        columns = [pc.if_else(pc.equal(c, ""), pa.scalar(None, pa.string()), c) for c in columns]
        return pa.table([pa.array([lang] * len(rows), pa.string()), *columns, rows.column("n")], names=["lang", *names, "n"])
    return run


def phrase_counts(documents: DataFrame, order: int = ORDER, least: int = MIN_COUNT) -> DataFrame:
    """lang, words (array), f: all phrases of at most ``order`` words that occur ``least`` times in their language.

    The row without words holds the number of all words of the language, however few.
    """
    work = workspace(documents)
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"]
    columns = [f"w{k + 1}" for k in range(order)]
    windows = (
        texts.mapInArrow(_chunks(order, parts(size, BUCKET_BYTES)), _CHUNKS).groupBy("lang", "bucket")
        .applyInArrow(_count(order, least), f"lang string, {', '.join(f'{c} string' for c in columns)}, n bigint")
    )
    sums = windows.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # The words of a rolled-up prefix; windows that were padded at the same place are no phrase of that length.
    length = order - F.bit_count("level")
    words = F.filter(F.array(*columns), lambda w: w.isNotNull())
    sums = sums.where("lang IS NOT NULL").select("lang", words.alias("words"), "f", length.alias("length"))
    return work.stage(sums.where(F.size("words") == F.col("length")).where((F.col("length") == 0) | (F.col("f") >= least))
                      .select("lang", "words", "f"), "phrases")


def collocations(documents: DataFrame, order: int = ORDER, least: int = MIN_COUNT, percent: int = PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``order`` words.

    a is the phrase's count, l and r those of the parts at its weakest cut, n that of all the language's words, score
    floor(1000000 a a / (l r)), exact for counts below 10^15.  A candidate inside a longer one of at least ``percent`` of its
    count is left out.  Ties go to the larger a, then the phrase's bytes.

    Null texts and texts without words add nothing; a null lang counts as ``und``.  Repeated rows and null or repeated ids
    count each time.  A language without candidates has no row, nor has an empty table.  Texts are read in slices, whatever
    their length.  Only lang and text are read.
    """
    work = workspace(documents)
    phrases = phrase_counts(documents, order, least)
    counts = phrases.where(F.size("words") > 0).select("lang", F.array_join("words", " ").alias("part"), "f")
    candidates = phrases.where(F.size("words") > 1).select("lang", "words", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"))

    part = lambda begin, length: F.array_join(F.slice("words", begin, length), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.size("words")).alias("rest"))
    cuts = cuts.join(counts.toDF("lang", "first", "l"), ["lang", "first"]).join(counts.toDF("lang", "rest", "r"), ["lang", "rest"])
    exact = lambda name: F.col(name).cast("decimal(15,0)")
    cuts = cuts.withColumn("above", exact("a") * exact("a") * F.lit(SCALE).cast("decimal(7,0)")).withColumn("below", exact("l") * exact("r"))
    weakest = cuts.withColumn("score", F.expr("above div below")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # Every shorter run of two or more words inside a candidate, with the count of the most frequent candidate around it.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.size("words") - size + 1), lambda begin: part(begin, size))))
    around = candidates.where(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longer"))
    left = weakest.join(around, ["lang", "phrase"], "left").where(100 * F.coalesce("longer", F.lit(0)) < percent * F.col("a"))
    scored = work.stage(left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scored")

    # The best of shares of each language first, so that no task ranks a whole language.
    order_by = [F.desc("score"), F.desc("a"), F.col("phrase")]
    shares = parts(scored.count(), RANKED)
    best = scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order_by))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by))).where(F.col("rank") <= top)
    totals = phrases.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_rollup_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
