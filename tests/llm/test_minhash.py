import hashlib

import numpy as np

from sluicebox.llm import minhash
from sluicebox.llm.minhash import fingerprint_edits, likeness, signatures, similar_documents


def words(n, seed):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 500, n))


def brute_set(text, size=5):
    w = text.lower().split()
    return {tuple(w[k:k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()


def test_likeness_estimates_jaccard():
    for share in (0, 10, 40, 200, 390):
        a = words(400, 1).split()
        b = a[:400 - share] + words(400, 2).split()[:share]
        a, b = " ".join(a), " ".join(b)
        x, y = brute_set(a), brute_set(b)
        marks = signatures([a.encode(), b.encode()])
        assert abs(likeness(marks[0], marks[1]) - len(x & y) / len(x | y)) < 0.15


def test_shingles_ignore_grouping_and_ascii_case():
    texts = [b"", b"  \n", b"One two", "é É x".encode(), words(70, 3).encode(), b"a", words(9, 4).upper().encode()]
    together = signatures(texts)
    for k, text in enumerate(texts):
        assert (signatures([text.lower()])[0] == together[k]).all()
    hashes, begin = minhash.shingle_hashes(texts)
    assert list(np.diff(begin)) == [0, 0, 1, 1, 66, 1, 5]


def test_fingerprint_edits(documents, monkeypatch):
    monkeypatch.setattr(minhash, "TASK_CHARS", 300)
    rows = [(k * 7, words(5 + k % 40, k % 9), "a") for k in range(60)]
    rows += [(500, None, "a"), (501, "", None), (502, "x" * 5001 + " é", "b"), (503, words(12000, 5), "b")]
    got = {r["doc_id"]: r for r in fingerprint_edits(documents(rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (doc_id, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = signatures([text.encode(), edited.encode(), after.encode()])
        assert r["fingerprint"] == minhash.hexed(a) and r["edited_fingerprint"] == minhash.hexed(b)
        assert r["near_edited"] == likeness(a, b) and r["near_next"] == likeness(a, c)


def test_edges(documents):
    assert fingerprint_edits(documents([])).count() == 0
    lone = fingerprint_edits(documents([(1, "a b c", None)])).first()
    assert lone["near_next"] == 1.0
    twice = fingerprint_edits(documents([(1, "a b c", None), (1, "a b c", None), (None, "z", None)])).collect()
    assert len(twice) == 3 and len({r["fingerprint"] for r in twice}) == 2


def test_similar_documents(documents):
    base = words(300, 8)
    rows = [(k, base + f" end{k}", "a") for k in range(30)] + [(40, base, "a"), (41, base.upper(), "a"), (50, words(300, 9), "a"), (51, None, "a"), (52, "", "a")]
    members, links = similar_documents(documents(rows))
    classes = {r["doc_id"]: r["class_id"] for r in members.collect()}
    assert classes[41] == 40 and classes[51] == 51 and classes[52] == 52
    pairs = {(r["left"], r["right"]) for r in links.collect()}
    assert {b for _, b in pairs} | {a for a, _ in pairs} == set(range(30)) | {40}
    texts = dict((i, t) for i, t, _ in rows)
    for r in links.collect():
        x, y = brute_set(texts[r["left"]]), brute_set(texts[r["right"]])
        assert r["jaccard"] == len(x & y) / len(x | y) >= 0.8


def test_links_are_found_beside_a_less_similar_least_member(documents):
    """A boilerplate of 300 shingles with 80 own ones in small ids, with 17 own ones in the last two (Jaccard 0.898)."""
    base = " ".join(f"b{k}" for k in range(304))
    text = lambda name, n: base + "".join(f" {name}{k}" for k in range(n))
    rows = [(k, text(f"own{k}x", 80), "a") for k in range(60)] + [(900, text("p", 17), "a"), (901, text("q", 17), "a"), (902, text("p", 17).upper(), "a")]
    members, links = similar_documents(documents(rows))
    assert [(r["left"], r["right"]) for r in links.collect()] == [(900, 901)]
    wanted = {k: k for k in range(60)} | {900: 900, 901: 900, 902: 900}
    assert {r["doc_id"]: r["component_id"] for r in members.collect()} == wanted
