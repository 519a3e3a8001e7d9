import random
import re
import zlib
from collections import Counter

import pytest

from sluicebox.llm.spelling import near_words, spelling_forms, spelling_variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_words(rows, shortest=6, least=5):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def brute(words, ratio=5):
    out = []
    form = {}
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


def collect(df):
    return sorted(tuple(r) for r in df.collect())


def mutate(word, rng, letters):
    k = rng.randrange(len(word) + 1)
    return rng.choice([word[:k] + rng.choice(letters) + word[k:], word[:k] + word[k + 1:], word[:k] + rng.choice(letters) + word[k + 1:]])


@pytest.mark.parametrize("letters,base", [("ab", 4), ("abé", 6), ("abcdefgÿ×", 11)])
def test_near_words_against_brute_force(spark, letters, base):
    """Few letters, so that many words share chunks, and all lengths from 3 on."""
    rng = random.Random(base)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(3, base + 3))) for _ in range(60)}
    for _ in range(3):
        words |= {mutate(w, rng, letters) for w in sorted(words)}
    words = sorted(w for w in words if len(w) > 2)[:400]
    got = collect(near_words(spark.createDataFrame([(w, k) for k, w in enumerate(words)], "word string, n bigint")).select("word", "near"))
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b)) and len(got) > 100


def test_forms_and_chains(spark):
    """Counts that grow along a chain of edits, ties and a ratio that is just met."""
    words = {"variant": 5, "variants": 25, "vaariants": 125, "vaariantsx": 625, "variantz": 25, "variantss": 24, "aaaaaa": 10, "aaaaab": 50, "aaaaac": 50,
             "aaaaad": 49, "loneword": 9, "éééééé": 5, "éééééb": 30}
    got = collect(spelling_forms(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert got == brute(words)
    assert dict((r[0], r[2]) for r in got)["variant"] == "vaariantsx"


def test_against_brute_force(documents):
    rng = random.Random(9)
    base = ["governor", "Parliament", "thought", "through", "ÉTUDE", "étudiant", "weather", "whether", "strength", "short", "naïveté", "×÷×÷×÷"]
    rows = []
    for k in range(700):
        words = [rng.choice(base) if rng.random() < 0.9 else mutate(rng.choice(base), rng, "eé") for _ in range(rng.randrange(1, 30))]
        rows.append((None if k % 50 == 7 else k - 20, rng.choice([" ", "-", "1", "\n", "ő"]).join(words), "a"))
    rows += [(1, None, "a"), (2, "", None), (2, "12 ..", "a"), (3, "governor " * 20_000, "a"), (4, "g" * 100_000, "a")] + [(5, "governor weathers", "b")] * 6
    rng.shuffle(rows)
    got = collect(spelling_variants(documents(rows)))
    words = brute_words(rows)
    assert got == brute(words) and len(got) > 20
    assert any(r[1] for r in got) and any(r[0] not in {b.encode().lower().decode() for b in base} for r in got)


def test_edges(spark, documents):
    assert spelling_variants(documents([])).count() == 0
    assert spelling_variants(documents([(1, None, "a"), (2, "", "a"), (3, "abcdefg", "a")])).count() == 0
    assert near_words(spark.createDataFrame([], "word string, n bigint")).count() == 0
    with pytest.raises(ValueError):
        spelling_forms(spark.createDataFrame([], "word string, n bigint"), ratio=1)
