import hashlib
import random
import re

from sluicebox.llm.winnowing import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute(rows, items):
    out = []
    for doc_id, text, _ in rows:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            m = min(13, len(v))
            spans = {tuple(v[k:k + m]) for k in range(len(v) - m + 1)} if m else set()
            for k in range(len(w) - m + 1):
                if m and tuple(w[k:k + m]) in spans:
                    hit.update(range(k, k + m))
                    found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def case():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([13, 20, 45]))) for k in range(12)] + [
        (90, "w1 w2"), (91, "É x"), (92, ""), (93, None), (94, "..."), (95, text(12)), (95, text(5)), (96, "w3 w3 w3")]
    rows = []
    for k in range(60):
        item = words(rng.choice(items)[1])
        cut = item[rng.randrange(3):len(item) - rng.randrange(3)]
        rows.append((k, text(rng.randrange(0, 300)) + ", " + " - ".join(cut).upper() + ". " + text(rng.randrange(0, 300)), "a"))
    rows += [(100, None, "a"), (101, "", None), (102, "!!", "a"), (103, "w3 w3 w3 w3", "a"), (104, "É X", "a"), (105, "é x", "a"),
             (106, " ".join(words(items[0][1])) * 1 + " z" * 400, "a")]
    return rows, items


def test_against_brute_force(spark, documents):
    rows, items = case()
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, words string")
    docs = documents(rows)
    got = sorted(map(tuple, contamination(docs, bench).collect()))
    assert got == brute(rows, items)
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [r[0] for r in got if not r[5]]


def test_edges(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert contamination(documents([]), bench).count() == 0
    assert contamination(documents([(1, "a b", "x")]), none).first()["contaminated"] is False
    assert drop_contaminated(documents([(1, "a b", "x")]), none).count() == 1
    twice = contamination(documents([(1, "a b", "x"), (1, "a b", "x"), (None, "a b", "x")]), bench).collect()
    assert len(twice) == 3 and sorted(r["n_hit"] for r in twice) == [2, 2, 2]


def test_null_and_repeated_ids(spark, documents):
    rng = random.Random(4)
    item, clean = " ".join(f"i{k}" for k in range(20)), " ".join(f"c{rng.randrange(99)}" for _ in range(60))
    short = " ".join(f"i{k}" for k in range(8))
    items = [(1, item), (2, "v1 v2 v3")]
    rows = [(None, item, "a"), (None, clean, "a"), (None, "v1 v2 v3", "b"), (None, None, "a"), (7, item, "a"), (7, clean, "a"),
            (7, short, "a"), (7, clean + " " + item, "a"), (8, item, "a"), (8, item, "a"), (9, "v1 v2 v3 v1 v2 v3", "a")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    key = lambda r: (repr(r[0]), *r[1:])
    wanted = [b for r in rows for b in brute([r], items)]
    assert sorted(map(tuple, contamination(documents(rows), bench).collect()), key=key) == sorted(wanted, key=key)
    kept = drop_contaminated(documents(rows), bench).collect()
    assert sorted((repr(r["doc_id"]), repr(r["text"])) for r in kept) == sorted(
        (repr(r[0]), repr(r[1])) for r in rows if not brute([r], items)[0][5])
