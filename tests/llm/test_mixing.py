import random

import pytest

from sluicebox.llm.mixing import highest_quotients, mix_sources


def targets(sizes):
    """Share out, set what is above to its limit, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            out.update({s: level * weight[s] for s in open_})
            break
        for s in above:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= above
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix(documents, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(300):
        source = rng.choice(["b", "a", "a", "a", "é", "Z", None, "tiny"] if seed != 3 else ["only"])
        rows.append((k, " ".join("x" for _ in range(3 if source == "tiny" else rng.choice([0, 1, 50, 400, 3000]))), source))
    rows += [(900, None, "a"), (901, "", None), (902, " \n ", "nothing"), (700, "a repeated id", "a"), (700, "a repeated id", "a"), (None, "no id", "b")]
    got = mix_sources(documents(rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix_sources(documents(rows)).collect()), key=str)
    assert len(got) == len(rows)
    sizes, taken, wanted = {}, {}, {}
    source_of = {r[0]: r[2] for r in rows}
    for r in got:
        s = source_of[r["doc_id"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[s], taken[s], wanted[s] = sizes.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"], r["target"]
    exact = targets(sizes)
    for s in sizes:
        assert abs(wanted[s] - exact[s]) < 1e-6 * max(1, exact[s])
        assert abs(taken[s] - wanted[s]) <= 130
        assert all(r["source_size"] == sizes[s] for r in got if source_of[r["doc_id"]] == s)


def test_quotas_are_sainte_lague(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    votes = [(k, "g", float(rng.choice([0, 1, 10, 1000, 54321]) + k)) for k in range(25)]
    for seats in (0, 1, 7, 100, 5003):
        got = {r["k"]: r["quota"] for r in highest_quotients(
            spark.createDataFrame(votes, "k int, g string, votes double"), ["g"], [F.col("k")], F.lit(seats)).collect()}
        won = dict.fromkeys(range(25), 0)
        for _ in range(seats):
            best = max((v / (2 * won[k] + 1), -k) for k, _, v in votes if v > 0)
            won[-best[1]] += 1
        assert got == won


def test_empty(documents):
    assert mix_sources(documents([])).count() == 0
    assert mix_sources(documents([(1, None, None)])).collect()[0][:] == (1, 0, 0, 0.0, 0)


@pytest.mark.parametrize("big,tiny,seats,wanted", [(1000.0, 1.0, 520, 500), (20000.0, 20.0, 406, 406), (1e6, 1.0, 90, 90), (5.0, 4.0, 301, 1)])
def test_quotas_of_one_big_row_and_many_tiny_ones(spark, big, tiny, seats, wanted):
    from pyspark.sql import functions as F

    votes = [(0, "g", big)] + [(k, "g", tiny) for k in range(1, 301)]
    got = {r["k"]: r["quota"] for r in highest_quotients(
        spark.createDataFrame(votes, "k int, g string, votes double"), ["g"], [F.col("k")], F.lit(seats)).collect()}
    won = dict.fromkeys(range(301), 0)
    for _ in range(seats):
        best = max((v / (2 * won[k] + 1), -k) for k, _, v in votes)
        won[-best[1]] += 1
    assert got == won and got[0] == wanted
