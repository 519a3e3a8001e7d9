import random
import re
from collections import Counter

import pytest

from sluicebox.llm import collocations as module
from sluicebox.llm.collocations import collocations

LANGS = "doc_id bigint, text string, lang string, n bigint, rank int, words string"


@pytest.fixture(scope="module")
def texts(spark):
    """Documents with extra columns whose names clash with those the operator uses inside."""
    def make(rows):
        return spark.createDataFrame([(k, t, g, 1, 2, "x") for k, (t, g) in enumerate(rows)], LANGS)
    return make


def brute(rows, order=3, least=10, percent=50, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").encode().lower().decode()):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, order + 1):
                for k in range(len(words) - size + 1):
                    counts[lang, tuple(words[k:k + size])] += 1
    found = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    gone = {(lang, w[k:k + m]) for (lang, w), b in found.items() for m in range(2, len(w)) for k in range(len(w) - m + 1)
            if 100 * b >= percent * counts[lang, w[k:k + m]]}
    out = []
    for lang in totals:
        rows = []
        for (g, words), a in found.items():
            if g == lang and (g, words) not in gone:
                score, _, left, right = min(
                    (1_000_000 * a * a // (counts[g, words[:k]] * counts[g, words[k:]]), k, counts[g, words[:k]], counts[g, words[k:]])
                    for k in range(1, len(words)))
                rows.append((-score, -a, " ".join(words).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, totals[lang], -score)
                for k, (score, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def corpus(rng, n):
    words = ["the", "The", "of", "a", "ñu", "Éa", "x y", "new", "york", "city", "and", "-", "\"q\"", "z\x00z", "NA"]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randrange(0, 60)):
            text += rng.choice(["New York City", rng.choice(words), rng.choice(words[:4])]) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  ", "\r", "?"])
        rows.append((text, rng.choice(["en", "en", "en", "fr", None, "und", "a\tb\nc"])))
    return rows


@pytest.mark.parametrize("chunk,piece,bucket,ranked", [(8_000_000, 1_000_000, 4_000_000, 1_000_000), (300, 20, 500, 7)])
def test_against_brute_force(texts, monkeypatch, chunk, piece, bucket, ranked):
    monkeypatch.setattr(module, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(module, "SLICE_BYTES", piece)
    monkeypatch.setattr(module, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(module, "RANKED", ranked)
    rows = corpus(random.Random(4), 60)
    got = sorted(map(tuple, collocations(texts(rows)).collect()))
    assert got == brute(rows) and len(got) > 20


@pytest.mark.parametrize("order,least,percent,top", [(2, 3, 50, 5), (4, 4, 80, 2000), (3, 1, 50, 20)])
def test_parameters(texts, order, least, percent, top):
    rows = corpus(random.Random(order), 30)
    got = sorted(map(tuple, collocations(texts(rows), order, least, percent, top).collect()))
    assert got == brute(rows, order, least, percent, top)


def test_edges(texts):
    assert collocations(texts([])).count() == 0
    assert collocations(texts([(None, "en"), ("", None), (" . \t", "en"), ("one two", "en")])).count() == 0
    long_word = "w" * 3_000_000
    rows = [("new york " * 40, "en"), (f"{long_word} new york, " * 12, "en"), ("new york", None), ("new york", None)] + [("a b", "fr")] * 10
    assert sorted(map(tuple, collocations(texts(rows)).collect())) == brute(rows)


def test_products_beyond_64_bits(spark, texts, monkeypatch):
    """Counts of 10^12, as the phrases of a corpus of 100 TB may have."""
    phrases = [(["x", "y"], 10 ** 12 + 7), (["x"], 3 * 10 ** 12 + 1), (["y"], 2 * 10 ** 12 + 3), ([], 10 ** 13)]
    counted = spark.createDataFrame([("en", w, f) for w, f in phrases], "lang string, words array<string>, f bigint")
    monkeypatch.setattr(module, "phrase_counts", lambda *_: counted)
    a, left, right = 10 ** 12 + 7, 3 * 10 ** 12 + 1, 2 * 10 ** 12 + 3
    assert [tuple(r) for r in collocations(texts([])).collect()] == [("en", 1, "x y", a, left, right, 10 ** 13, 10 ** 6 * a * a // (left * right))]
