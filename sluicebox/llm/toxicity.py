"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams (bytes of the lower-cased text, hashed to
BUCKETS).  The ratios come from document counts over all labelled training
rows; a logistic regression on the scaled features is fitted on a bounded,
seeded sample of them.  The model is one weight per bucket, so its size does
not grow with the input.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import table, workspace

GRAMS = (4, 5, 6)
BUCKETS = 1 << 18
SMOOTH = 1.0
#: n-grams of fewer training documents carry no weight.
SUPPORT = 5
#: Rows of each label that the regression is fitted on, at most.
SAMPLE = 1200
#: Bytes of those rows' texts, at most; a row that does not fit is passed over, and later ones that do are used.
SAMPLE_BYTES = 16_000_000
RIDGE = 10.0
ROUNDS = 40
FOLDS = 5
#: A table of at most so many labels (12 MB) may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
HELD_OUT = 0

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 18)


class Grams:
    """Distinct n-gram buckets of one text after another; the scratch table makes that free of sorting."""

    def __init__(self):
        self.last = np.zeros(BUCKETS, np.int64)

    def __call__(self, text: str | None) -> np.ndarray:
        raw = b" " + (text or "").lower().encode() + b" "
        buf = np.frombuffer(raw, np.uint8).astype(np.uint64)
        with np.errstate(over="ignore"):
            rolled, found = buf, []
            for n in range(2, GRAMS[-1] + 1):
                if len(buf) < n:
                    break
                rolled = rolled[:-1] * _BASE + buf[n - 1:] + np.uint64(1)
                if n in GRAMS:
                    found.append((((rolled ^ (rolled >> np.uint64(29))) * _BASE) >> _SHIFT).astype(np.int64))
        if not found:
            return np.zeros(0, np.int64)
        buckets = np.concatenate(found)
        place = np.arange(len(buckets))
        self.last[buckets] = place
        return buckets[self.last[buckets] == place]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, buckets: np.ndarray) -> float:
        margin = self.bias + (float(self.weights[buckets].sum()) if len(buckets) else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60))))


_COUNTS = "bucket int, toxic bigint, clean bigint"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold each n-gram, and at BUCKETS all of them."""
    grams, counts = Grams(), np.zeros((2, BUCKETS + 1), np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            counts[toxic, grams(text.as_py())] += 1
            counts[toxic, BUCKETS] += 1
    some = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array(counts[1, some]), pa.array(counts[0, some])], names=["bucket", "toxic", "clean"])


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Naive Bayes ratios; 0 where an n-gram has too little support."""
    p, q = toxic + SMOOTH, clean + SMOOTH
    ratios = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where(toxic + clean >= SUPPORT, ratios, 0.0)


def fit(rows: list[tuple[np.ndarray, int]], ratios: np.ndarray, prior: float) -> Model:
    """Ridge logistic regression on ratio-scaled presence features, by gradient steps with momentum (Adam).

    ``prior`` is the share of toxic rows among all labelled ones; rows are
    weighed so that the sample has it too.
    """
    y = np.array([y for _, y in rows], float)
    weigh = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9)) / len(rows)
    w, bias = np.zeros(BUCKETS), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for k in range(1, ROUNDS + 1):
        scaled = w * ratios
        margin = bias + np.array([scaled[b].sum() for b, _ in rows])
        error = (1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60))) - y) * weigh
        g = np.zeros(BUCKETS)
        for e, (b, _) in zip(error, rows):
            g[b] += e  # a row's buckets are distinct
        g = g * ratios + RIDGE * w / len(rows)
        gb = error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.02 if k <= ROUNDS // 2 else 0.005
        w -= rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-9)
        bias -= rate * (mb / (1 - 0.9 ** k)) / (np.sqrt(vb / (1 - 0.99 ** k)) + 1e-9)
    return Model((w * ratios).astype(np.float32), float(bias))


def _fold():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def chosen(sizes: list[dict], room: int) -> dict[tuple[int, int], int]:
    """How often each text (id, mark) is used, in order while it fits into ``room`` bytes; the smallest if none does."""
    times = {}
    for r in sizes:
        fits = r["m"] if not r["size"] else min(r["m"], room // r["size"])
        if fits:
            times[r["id"], r["mark"]] = fits
            room -= fits * r["size"]
    if sizes and not times:
        least = min(sizes, key=lambda r: r["size"])
        times[least["id"], least["mark"]] = 1
    return times


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of all labelled rows whose fold is not HELD_OUT.

    Several labels of one document count as toxic if one of them is; null
    labels do not count.  Without rows of both labels every text gets the
    smoothed share of toxic ones.
    """
    work = workspace(documents)
    marks = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = work.stage(marks.where("toxic IN (0, 1)").where(_fold() != HELD_OUT), "marks")
    few = marks.count() <= BROADCAST_ROWS
    # Few labels go to the texts; many meet them in one shuffle, and the labelled texts are written once.
    known = documents.select("doc_id", "text").join(F.broadcast(marks) if few else marks, "doc_id")
    known = known if few else work.stage(known, "known")
    counted = known.select("text", "toxic").mapInArrow(_count, _COUNTS)
    # At most BUCKETS + 1 rows, whatever the input.
    counts = counted.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    bucket = counts.column("bucket").to_numpy()
    toxic, clean = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    toxic[bucket], clean[bucket] = counts.column("toxic").to_numpy(), counts.column("clean").to_numpy()
    totals = toxic[BUCKETS], clean[BUCKETS]
    share = (totals[0] + 0.1) / (sum(totals) + 1.0)
    if not all(totals):
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    ratios = log_count_ratios(toxic[:BUCKETS], clean[:BUCKETS])
    rows, useful = [], ratios != 0

    def listed(batches):
        """The buckets of a text that carry weight: of any text at most BUCKETS numbers."""
        grams = Grams()
        for batch in batches:
            found = [grams(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), pa.array([b[useful[b]].astype(np.int32) for b in found], pa.list_(pa.int32()))],
                names=["id", "mark", "buckets"])

    for label in (1, 0):
        # Ids first, without their texts; at most SAMPLE rows.
        ids = known.where(F.col("toxic") == label).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        sample = known.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(
            F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"), "text")
        # Then the texts' sizes; no text reaches the driver.
        size = F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")
        sizes = sample.groupBy("id", "mark", size).agg(F.count("*").alias("m")).orderBy(F.xxhash64("id"), "id", "mark").toArrow().to_pylist()
        times = chosen(sizes, SAMPLE_BYTES // 2)
        if not times:
            continue
        picked = documents.sparkSession.createDataFrame(list(times), "id bigint, mark bigint")
        lists = sample.join(F.broadcast(picked), ["id", "mark"]).dropDuplicates(["id", "mark"]).select("id", "mark", "text").mapInArrow(
            listed, "id bigint, mark bigint, buckets array<int>").toArrow()
        found = {(i, m): b.values.to_numpy() for i, m, b in zip(lists.column("id").to_pylist(), lists.column("mark").to_pylist(), lists.column("buckets"))}
        rows += [(found[name], label) for name, m in times.items() for _ in range(m)]
    return fit(rows, ratios, share)


_SCORES = "doc_id bigint, held_out boolean, score double, predicted int"


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text; one row per input row.

    Null texts count as empty; a null doc_id is not held out and never
    trained on.  Repeated rows get equal scores.  An empty table gives no
    rows.  Of documents only doc_id and text are read, of labels doc_id and toxic.
    """
    model = train(documents, labels)
    sent = documents.sparkSession.sparkContext.broadcast(model)  # 1 MB, fixed by BUCKETS

    def score(batches):
        grams, model = Grams(), sent.value
        for batch in batches:
            scores = np.array([model.score(grams(t.as_py())) for t in batch.column("text")], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select("doc_id", F.coalesce(_fold() == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(score, _SCORES)


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, all columns, judged row by row."""
    model = train(documents, labels)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.schema

    def keep(batches):
        grams, model = Grams(), sent.value
        for batch in batches:
            fine = [model.score(grams(t.as_py())) < 0.5 for t in batch.column("text")]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return documents.mapInArrow(keep, schema)


def op5_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
