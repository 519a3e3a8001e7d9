"""The stages on a small corpus, each held against a plain version on what its predecessor kept."""
import hashlib
import random

import pytest

import corpus_pipeline
from tests.llm.test_prefix_join import brute as brute_components
from tests.llm.test_repeats import brute as brute_repeats
from tests.llm.test_winnowing import brute as brute_hits


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    syllables = ["ba", "lo", "ke", "mi", "sun", "tor", "é"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    bench = [(k, text(30)) for k in range(5)]
    rows, labels = [], []
    for k in range(160):
        own = text(rng.randrange(20, 120))
        if k % 4 == 0:
            own += " snarlfoul vilegrub " + text(3)
        if k % 10 == 3:
            own = f"{text(10)} {bench[k % 5][1]} {text(40)}"
        if k % 9 == 2:
            own += " the passage of sixty words and more " + " ".join(f"passage{j}" for j in range(60))
        if k % 7 == 6 and rows:
            own = rows[-1][1] + (" more" if k % 2 else "")
        rows.append((k, own, "en", f"s{k % 4}", len(own)))
        labels.append((k, 1, int("vilegrub" in own)))
    rows += [(500, None, None, None, None), (501, "", "en", "s1", 0)]
    base = str(tmp_path_factory.mktemp("corpus"))
    for name, data, schema in (("documents", rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
                               ("labels", labels, "doc_id bigint, quality int, toxic int"), ("benchmark", bench, "item_id bigint, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{base}/{name}.parquet")
    return base, bench


def test_stages(spark, folder):
    base, bench = folder
    docs = spark.read.parquet(f"{base}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{base}/{name}"
        stage(spark, kept[-1], base).write.parquet(path)
        kept.append(spark.read.parquet(path))
        assert kept[-1].dtypes == docs.dtypes
    rows = [sorted((r["doc_id"], r["text"], r["source"]) for r in k.collect()) for k in kept]

    assert {r[0] for r in rows[0]} - {r[0] for r in rows[1]} >= {k for k in range(0, 160, 4) if "vilegrub" in (rows[0][k][1] or "")}
    assert 500 in {r[0] for r in rows[1]}
    assert [r[0] for r in rows[2]] == [i for i, _, c in brute_components(rows[1]) if i == c]
    wanted = brute_repeats([r[:2] for r in rows[2]], 100)
    assert [r[0] for r in rows[3]] == [w[0] for w in wanted]
    for (_, text, _), w in zip(rows[3], wanted):
        if text is not None and w[2] and "é" not in text:
            assert hashlib.sha256(text.encode()).hexdigest() == w[4]
    assert sum(w[2] > 0 for w in wanted) > 3
    assert [r[0] for r in rows[4]] == [b[0] for b in brute_hits(rows[3], bench) if not b[5]]
    assert len(rows[4]) < len(rows[3]) < len(rows[1])

    mixed = corpus_pipeline.run(spark, base).collect()
    assert sorted(r["doc_id"] for r in mixed) == [r[0] for r in rows[4]]
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in mixed)


def test_copies_with_some_words_replaced_go(spark, documents):
    """1,000 words with 20 spread substitutions: 5-word Jaccard 0.82, 3-word Jaccard 0.89; with 30 it is below 0.8."""
    def copy(name, every):
        return " ".join(f"{name}{k}" if every and k % every == every // 2 else f"base{k}" for k in range(1000))

    def jaccard(a, b, size):
        x, y = ({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} for w in (a.split(), b.split()))
        return len(x & y) / len(x | y)

    near, far = copy("near", 50), copy("far", 33)
    assert jaccard(copy("", 0), near, 5) >= 0.8 and jaccard(copy("", 0), near, 3) < 0.9 and jaccard(copy("", 0), far, 5) < 0.8
    docs = documents([(1, copy("", 0), "a"), (2, near, "a"), (3, far, "a")])
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [1, 3]
