import random

import pytest

from sluicebox.llm import prefix_join
from sluicebox.llm.prefix_join import keep_one_per_component, similar_components


def brute(rows):
    sets = []
    for doc_id, text, _ in rows:
        w = (text or "").encode().lower().split()
        sets.append((doc_id, {tuple(w[k:k + 3]) for k in range(max(len(w) - 2, 1))} if w else set()))
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(sets):
        least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    return sorted((doc_id, len(s), least[root(k)] if s else doc_id) for k, (doc_id, s) in enumerate(sets))


def edited(words, edits, rng, vocabulary):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return " ".join(words)


@pytest.mark.parametrize("pivots,rounds", [(1, 0), (4, 1), (4, 6)])
def test_components_against_brute_force(documents, monkeypatch, pivots, rounds):
    monkeypatch.setattr(prefix_join, "PIVOTS", pivots)
    monkeypatch.setattr(prefix_join, "ROUNDS", rounds)
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(60)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            rows.append((len(rows) * 3 + 1, edited(base, rng.choice([0, 0, 1, 2, 3, 5]), rng, vocabulary) + " the common line of all", "a"))
    rows += [(1000, None, "a"), (1001, "", "b"), (1002, " \n ", None), (1003, "Two words", "a"), (1004, "two WORDS", "a"),
             (1005, "É x y", "a"), (1006, "é x y", "a"), (1007, "the common line of all", "a"), (0, "the common line of all", "a")]
    rng.shuffle(rows)
    got = sorted(map(tuple, similar_components(documents(rows)).collect()))
    assert got == brute(rows)


def test_edges(documents):
    assert similar_components(documents([])).count() == 0
    assert similar_components(documents([(4, None, "a")])).collect()[0][:] == (4, 0, 4)
    kept = keep_one_per_component(documents([(2, "a b c d", "a"), (1, "A b c d", "a"), (3, None, "a"), (4, "", "a")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]
    assert "shard" in kept.columns
    again = similar_components(documents([(2, "a b c d", "a"), (2, "a b c d", "a"), (None, "q r s t", "a")])).collect()
    assert len(again) == 3


def test_no_distinct_text_is_deleted(spark, documents):
    """Rows that share a doc_id, or have none, go only with the component of their own text."""
    a, b, c = "one two three four five", "six seven eight nine ten", "eleven twelve thirteen"
    kept = keep_one_per_component(documents([(1, a, "a"), (5, a, "a"), (5, b, "a")]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, a), (5, b)]
    kept = keep_one_per_component(documents([(None, a, "a"), (None, a, "b"), (None, b, "a"), (3, b, "a"), (3, b, "a"), (None, None, "a"), (None, "", "a"), (4, c, "a")]))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, ""), (0, ""), (0, a), (3, b), (4, c)]
    clash = spark.createDataFrame([(1, a, 7, 8), (2, a, 7, 8), (3, b, 7, 8)], "doc_id bigint, text string, gone int, judged_row int")
    kept = keep_one_per_component(clash)
    assert kept.columns == clash.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    assert keep_one_per_component(documents([])).count() == 0


def test_a_large_group_just_below_the_threshold(documents):
    """Copies with many edits resemble each other just too little, and copies with few edits link through some of them."""
    rng = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = [(k, edited(base, rng.choice([1, 2, 3, 4, 6, 9]), rng, [f"new{k}x{j}" for j in range(40)]), "a") for k in range(150)]
    got = sorted(map(tuple, similar_components(documents(rows)).collect()))
    assert got == brute(rows) and 1 < len({r[2] for r in got}) < 150
