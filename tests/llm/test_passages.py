import random
import zlib

import numpy as np
import pytest

from sluicebox.llm import passages as module
from sluicebox.llm.passages import FEATURES, PASSAGE, Model, encode, fit, gradients, quality


def corpus(n, rng):
    """Good documents, and bad ones with a passage of junk somewhere in good text."""
    calm = [f"{a}{b}" for a in ("ban", "lor", "mit", "sen", "tur", "é") for b in ("da", "ke", "lo", "mi", "nu", "po")]
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(calm) for _ in range(rng.randrange(20, 300))]
        bad = k % 4 == 0
        if bad:
            junk = rng.choice([["$$$%%"], ["CLICK!!", "NOW!!"], [rng.choice(calm)]])
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(junk) for _ in range(rng.randrange(120, 200))]
        rows.append((k, " ".join(words), "a"))
        labels.append((k, int(not bad), None))
    return rows, labels


def trained(rng, documents=12):
    model = Model.start(0.7)
    for value in vars(model).values():
        value += rng.standard_normal(value.shape) * 0.3
    sizes = rng.integers(1, 6, documents)
    x = rng.random((sizes.sum(), FEATURES)) * 0.05
    return model, x, np.cumsum(sizes) - sizes, rng.integers(0, 2, documents).astype(float), rng.random(documents)


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    model, x, begin, y, weigh = trained(rng)
    for name, value in list(vars(model).items()):
        setattr(model, name, value.astype(float))
    _, slopes = gradients(model, x, begin, y, weigh)
    for name, slope in slopes.items():
        value = getattr(model, name)
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in value.shape)
            kept, losses = value[at], []
            for move in (1e-5, -1e-5):
                value[at] = kept + move
                losses.append(gradients(model, x, begin, y, weigh)[0])
            value[at] = kept
            assert slope[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-7)


def test_scores_against_plain_attention(monkeypatch):
    """Texts in slices score as the formula over all their passages at once."""
    model = trained(np.random.default_rng(5))[0]
    rng = random.Random(2)
    texts = [None, "", "é", "x" * PASSAGE, "x" * (PASSAGE + 1), "".join(rng.choice("abc ÉX.\n!") for _ in range(40_000)), "tail"]
    wanted = []
    for text in texts:
        x = np.concatenate([x for _, x in encode([text])])
        assert len(x) == max(-(-len((text or "").encode()) // PASSAGE), 1)
        h = np.tanh(x @ model.W + model.b)
        e = (np.tanh(h @ model.V) / (1 + np.exp(-(h @ model.U)))) @ model.w
        alpha = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
        wanted.append(1 / (1 + np.exp(-(alpha @ h @ model.c + model.d[0]))))
        assert model.attention(text) == pytest.approx(alpha, abs=1e-5)
    for size in (module.SLICE, 4 * PASSAGE):
        monkeypatch.setattr(module, "SLICE", size)
        assert model.scores(texts) == pytest.approx(np.array(wanted), abs=2e-6)
    assert len(model.scores([])) == 0


def test_attention_finds_the_passage():
    rng = random.Random(4)
    rows, labels = corpus(160, rng)
    model = fit([(np.concatenate([x for _, x in encode([t])]), y) for (_, t, _), (_, y, _) in zip(rows, labels)], 0.75)
    calm, junk = rows[1][1] + " ", "CLICK!! NOW!! " * 40
    text = (calm * 20)[:8 * PASSAGE] + junk[:PASSAGE] + (calm * 20)[:8 * PASSAGE]
    shares = model.attention(text)
    assert shares[8] > 1.5 / len(shares)


def test_held_out_accuracy_and_edges(spark, documents):
    rows, labels = corpus(500, random.Random(3))
    extra = [(1000, None, "a"), (1001, "", None), (1002, "banda lorke " * 200_000, "a"), (1003, "CLICK!! NOW!! " * 50, "a"),
             (None, "banda", "a"), (1003, "CLICK!! NOW!! " * 50, "a")]
    marks = spark.createDataFrame(labels + [(0, 0, 1), (5, None, None), (None, 1, 1), (7, 9, 0)], "doc_id bigint, quality int, toxic int")
    got = quality(documents(rows + extra), marks).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: y for i, y, _ in labels}
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    rest = {r["doc_id"]: r for r in got}
    assert rest[1000]["score"] == rest[1001]["score"] and rest[1003]["predicted"] == 0
    assert len({r["score"] for r in got if r["doc_id"] == 1003}) == 1


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality(documents([(1, "a", "a"), (2, "b", "a")]), none).collect()
    assert got[0]["score"] == got[1]["score"] == 0.5
    assert quality(documents([]), none).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark, documents):
    rows, labels = corpus(80, random.Random(6))
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, t) for i, y, t in labels]
    schema = "doc_id bigint, quality int, toxic int"
    scores = [sorted((r["doc_id"], r["score"]) for r in quality(documents(rows), spark.createDataFrame(m, schema)).collect()) for m in (labels, other)]
    assert scores[0] == scores[1]


def test_picked():
    rows = [{"id": k, "mark": 9, "size": s, "label": 1} for k, s in enumerate([500, 40, 0, 30, 60])]
    assert [p[0] for p in module._picked(rows, 100)] == [1, 2, 3]
    assert module._picked(rows[:1], 100) == [(0, 9, 1)] and module._picked([], 5) == []
