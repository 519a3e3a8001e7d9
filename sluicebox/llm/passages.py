"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE bytes.  Each is encoded from its
trigrams of bytes (hashed) and of character classes; gated attention
(tanh(V h) * sigmoid(U h), weighed and normalised over the document's passages)
says how much each counts; the weighted mean of the encodings is scored.  Only
documents have labels: which passages matter is learnt with the rest.

The sums under the attention's normalisation are additive, so a text of any
length is scored slice by slice.  The model is some 35,000 numbers, whatever the
input.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import table, workspace

PASSAGE = 512
#: Features of a passage: trigrams of 8 character classes, hashed trigrams of bytes, and how much these repeat.
CLASSES, HASHED, REPEATS = 512, 512, 3
FEATURES = CLASSES + HASHED + REPEATS
HIDDEN, GATES = 32, 16
#: Documents of each label that the model is fitted on, at most.
SAMPLE = 1000
#: Bytes of those documents' texts, at most; one that does not fit is passed over, and later ones that do are used.
SAMPLE_BYTES = 8_000_000
#: Passes over the sample; more of a small one, so that there are STEPS steps.
EPOCHS, STEPS, BATCH, RATE, RIDGE = 14, 600, 64, 0.004, 1e-4
#: A text counts as good from this score on.
GOOD = 0.3
FOLDS, HELD_OUT = 5, 0
#: A table of at most so many labels (12 MB) may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
#: Bytes that are encoded at a time.
SLICE = 2048 * PASSAGE


def _class_table() -> np.ndarray:
    """Lower case, upper case, digits, blanks, line ends, marks of a sentence, other signs, bytes beyond ASCII."""
    kind = np.full(256, 6, np.uint32)
    kind[128:] = 7
    for number, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\x0c", b".,;:'\"-()?")):
        kind[list(members)] = number
    return kind


_KIND = _class_table()


def encode(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The number of the text and the features of every passage; each text has one at least.

    Texts come in order, about SLICE bytes at a time; a longer one goes on in the next.
    """
    units, amount = [], 0
    for number, text in enumerate(texts):
        data = (text or "").encode() + b"  "  # as many trigrams as bytes
        for at in range(0, max(len(data) - 2, 1), SLICE):
            units.append((number, data[at:at + SLICE + 2]))
            amount += len(units[-1][1]) + PASSAGE // 2
            if amount >= SLICE:
                yield _features(units)
                units, amount = [], 0
    if units:
        yield _features(units)


def _features(units: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(data) for _, data in units])
    count = np.maximum(-(-(length - 2) // PASSAGE), 1)
    base, begin = np.cumsum(count) - count, np.cumsum(length) - length
    raw = np.frombuffer(b"".join(data for _, data in units) + b"  ", np.uint8).astype(np.uint32)
    place = np.arange(length.sum()) - np.repeat(begin, length)
    real = place < np.repeat(length - 2, length)
    passage = (np.repeat(base, length) + place // PASSAGE)[real]
    kind = _KIND[raw]
    shape = (kind[:-2] * 64 + kind[1:-1] * 8 + kind[2:])[real]
    gram = (((raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16) * np.uint32(2654435761)) >> np.uint32(23))[real]
    parts = [np.bincount(passage * size + index, minlength=int(count.sum()) * size).reshape(-1, size) for size, index in ((CLASSES, shape), (HASHED, gram))]
    total = np.maximum(parts[0].sum(axis=1, keepdims=True), 1)
    shares = [(part / total).astype(np.float32) for part in parts]
    entropy = -(shares[1] * np.log2(shares[1], where=shares[1] > 0, out=np.zeros_like(shares[1]))).sum(axis=1, keepdims=True)
    width = np.log2(total)
    repeats = [(width - entropy) / 2, (parts[1] > 0).sum(axis=1, keepdims=True) / total, width / np.log2(PASSAGE)]
    x = np.hstack([*map(np.sqrt, shares), *(r.astype(np.float32) for r in repeats)])
    return np.repeat([number for number, _ in units], count), x


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    W: np.ndarray
    b: np.ndarray
    V: np.ndarray
    U: np.ndarray
    w: np.ndarray
    c: np.ndarray
    d: np.ndarray

    @classmethod
    def start(cls, share: float) -> Model:
        rng = np.random.default_rng(13)
        draw = lambda rows, columns, scale: (rng.standard_normal((rows, columns)) * scale).astype(np.float32)
        return cls(draw(FEATURES, HIDDEN, 1.0), np.zeros(HIDDEN, np.float32), draw(HIDDEN, GATES, HIDDEN ** -0.5), draw(HIDDEN, GATES, HIDDEN ** -0.5),
                   draw(GATES, 1, 0.1)[:, 0], np.zeros(HIDDEN, np.float32), np.array([np.log(share / (1 - share))], np.float32))

    def weigh(self, x: np.ndarray):
        """Encodings, gates and the unnormalised attention; the gates lie within -1 and 1, so no exponent is large."""
        h = np.tanh(x @ self.W + self.b)
        t, g = np.tanh(h @ self.V), _sigmoid(h @ self.U)
        return h, t, g, np.exp((t * g) @ self.w)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 of each whole text."""
        weight, pooled = np.zeros(len(texts)), np.zeros((len(texts), HIDDEN))
        for number, x in encode(texts):
            h, _, _, a = self.weigh(x)
            begin = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
            weight[number[begin]] += np.add.reduceat(a, begin)
            pooled[number[begin]] += np.add.reduceat(a[:, None] * h, begin)
        if not len(texts):
            return np.zeros(0)
        return np.round(_sigmoid((pooled / weight[:, None]) @ self.c.astype(float) + float(self.d[0])), 6)

    def attention(self, text: str | None) -> np.ndarray:
        """The share of each passage of a text."""
        a = np.concatenate([self.weigh(x)[3] for _, x in encode([text])])
        return a / a.sum()


def gradients(model: Model, x: np.ndarray, begin: np.ndarray, y: np.ndarray, weigh: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted cross entropy of documents, whose passages begin at ``begin``, and its gradient."""
    of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(x))))
    h, t, g, a = model.weigh(x)
    alpha = a / np.add.reduceat(a, begin)[of]
    z = np.add.reduceat(alpha[:, None] * h, begin)
    p = _sigmoid(z @ model.c + model.d[0])
    loss = -float((weigh * np.log(np.where(y == 1, p, 1 - p) + 1e-9)).sum())
    error = (p - y) * weigh
    back = (error[:, None] * model.c)[of]
    pull = (back * h).sum(axis=1)
    e = alpha * (pull - np.add.reduceat(alpha * pull, begin)[of])
    gate = e[:, None] * model.w
    dt, dg = gate * g * (1 - t * t), gate * t * g * (1 - g)
    inner = (alpha[:, None] * back + dt @ model.V.T + dg @ model.U.T) * (1 - h * h)
    return loss, {"W": x.T @ inner, "b": inner.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ e, "c": z.T @ error, "d": error.sum(keepdims=True)}


def fit(bags: list[tuple[np.ndarray, int]], share: float) -> Model:
    """The model of documents (features of their passages, label) by Adam; ``share`` is label 1's among all labelled ones.

    Documents are weighed so that the sample has that share, too.
    """
    model = Model.start(share)
    y = np.array([label for _, label in bags], float)
    weigh = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    rng = np.random.default_rng(7)
    moments = {name: (np.zeros_like(value), np.zeros_like(value)) for name, value in vars(model).items()}
    step, epochs = 0, max(EPOCHS, STEPS // -(-len(bags) // BATCH))
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), BATCH):
            some = order[at:at + BATCH]
            sizes = [len(bags[k][0]) for k in some]
            x = np.concatenate([bags[k][0] for k in some]).astype(np.float32)
            _, slopes = gradients(model, x, np.cumsum(sizes) - sizes, y[some], weigh[some] / len(some))
            step += 1
            rate = RATE * (1.0 if epoch < epochs * 2 // 3 else 0.25)
            for name, slope in slopes.items():
                value, (m, v) = getattr(model, name), moments[name]
                slope = slope + RIDGE * value
                m += 0.1 * (slope - m)
                v += 0.01 * (slope * slope - v)
                value -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def _fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def _picked(rows: list, room: int) -> list[tuple[int, int, int]]:
    """Those of the rows (id, mark, size, label), in order, that fit into ``room`` bytes; the smallest if none does."""
    out = []
    for r in rows:
        if r["size"] <= room:
            out.append((r["id"], r["mark"], r["label"]))
            room -= r["size"]
    least = min(rows, key=lambda r: r["size"], default=None)
    return out if out or least is None else [(least["id"], least["mark"], least["label"])]


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of labelled documents whose fold is not HELD_OUT.

    Several labels of one document count as the highest; null labels and null ids do not count.  Without rows of both labels
    every text gets the smoothed share of label 1.
    """
    work = workspace(documents)
    marks = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("label"))
    marks = work.stage(marks.where(_fold() != HELD_OUT), "marks")
    few = marks.count() <= BROADCAST_ROWS
    size = F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")
    known = documents.select(F.col("doc_id"), F.xxhash64("text").alias("mark"), size).join(F.broadcast(marks) if few else marks, "doc_id")
    known = work.stage(known, "known")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = (counts.get(1, 0) + 0.1) / (sum(counts.values()) + 0.2)
    if len(counts) < 2:
        return Model.start(share)
    picked = []
    for label in counts:
        rows = known.where(F.col("label") == label).select(F.col("doc_id").alias("id"), "mark", "size", "label").distinct()
        # Ids and sizes of at most SAMPLE rows; no text reaches the driver.
        picked += _picked(rows.orderBy(F.xxhash64("id"), "id", "mark").limit(SAMPLE).collect(), SAMPLE_BYTES // 2)
    chosen = documents.sparkSession.createDataFrame(picked, "id bigint, mark bigint, label int")
    texts = documents.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"), "text").join(F.broadcast(chosen), ["id", "mark"])

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                x = np.concatenate([x for _, x in encode(batch.column("text").slice(k, 1).to_pylist())])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(k, 1) for c in ("id", "mark", "label")), pa.array([x.astype(np.float16).tobytes()])],
                    names=["id", "mark", "label", "bag"])

    found = texts.dropDuplicates(["id", "mark"]).select("id", "mark", "label", "text").mapInArrow(
        bags, "id bigint, mark bigint, label int, bag binary").toArrow().sort_by([("id", "ascending"), ("mark", "ascending")])
    read = lambda bag: np.frombuffer(bag.as_buffer(), np.float16).reshape(-1, FEATURES)
    return fit([(read(bag), label) for bag, label in zip(found.column("bag"), found.column("label").to_pylist())], share)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text; one row per input row.

    Null texts count as empty; a null doc_id is not held out and never trained on.  Repeated rows get equal scores.  An
    empty table gives no rows.  Of documents only doc_id and text are read, of labels doc_id and quality.
    """
    sent = documents.sparkSession.sparkContext.broadcast(train(documents, labels))  # 0.2 MB, fixed by the model's size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            scores = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(scores), pa.array((scores >= GOOD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select("doc_id", F.coalesce(_fold() == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id bigint, held_out boolean, score double, predicted int")


def op13_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
