import random
import zlib

from sluicebox.llm import toxicity as toxicity_module
from sluicebox.llm.toxicity import drop_toxic, toxicity


def corpus(n, rng):
    calm = [f"{a}{b}" for a in ("ban", "lor", "mit", "sen", "tur") for b in ("da", "ke", "lo", "mi", "nu", "po")]
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(calm) for _ in range(rng.randrange(5, 80))]
        toxic = k % 4 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["vilegrub", "snarlfoul"]))
        rows.append((k, " ".join(words), "a"))
        labels.append((k, None, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_edges(spark, documents):
    rows, labels = corpus(400, random.Random(3))
    extra = [(1000, None, "a"), (1001, "", None), (1002, "word " * 30000, "a"), (1003, "so VILEGRUB of you", "a"), (None, "x", "a"),
             (1003, "so VILEGRUB of you", "a")]
    marks = spark.createDataFrame(labels + [(0, 1, 1), (5, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    docs = documents(rows + extra)
    got = toxicity(docs, marks).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: y for i, _, y in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    rest = {r["doc_id"]: r for r in got}
    assert rest[1003]["predicted"] == 1 and rest[1000]["predicted"] == 0 and rest[1000]["score"] == rest[1001]["score"]
    kept = drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 - r["predicted"] for r in got)


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = toxicity(documents([(1, "a", "a")]), none).collect()
    assert got[0]["predicted"] == 0 and 0 <= got[0]["score"] <= 1
    assert toxicity(documents([]), none).count() == 0


def test_a_text_beyond_the_sample_does_not_end_it(spark, documents, monkeypatch):
    """One labelled text larger than the sample's bytes stands first among the toxic ones, in whatever order."""
    monkeypatch.setattr(toxicity_module, "SAMPLE_BYTES", 400_000)
    rows, labels = corpus(400, random.Random(3))
    huge = [(i, "vilegrub " + "word " * 60_000, "a") for i in range(2000, 2030)]
    marks = spark.createDataFrame(labels + [(i, None, 1) for i, _, _ in huge], "doc_id bigint, quality int, toxic int")
    truth = {i: y for i, _, y in labels}
    held = [r for r in toxicity(documents(rows + huge), marks).collect() if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_chosen():
    sizes = [{"id": k, "mark": 9, "size": s, "m": m} for k, (s, m) in enumerate([(500, 1), (40, 3), (0, 2), (30, 1), (10, 1)])]
    assert toxicity_module.chosen(sizes, 100) == {(1, 9): 2, (2, 9): 2, (4, 9): 1}
    assert toxicity_module.chosen(sizes[:1], 100) == {(0, 9): 1} and toxicity_module.chosen([], 5) == {}
