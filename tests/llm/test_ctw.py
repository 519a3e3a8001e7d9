import itertools
import math
import zlib

import numpy as np
import pytest

from sluicebox.llm import ctw
from sluicebox.llm.ctw import DEPTH, kt_block, log_gamma, score_texts, tokens_of


def test_log_gamma():
    for x in (0.5, 1, 1.5, 2, 7.9, 8, 33.5, 1e4, 1e9):
        assert math.isclose(float(log_gamma(np.array([x]))[0]), math.lgamma(x), rel_tol=1e-9, abs_tol=1e-9)
    assert math.isclose(math.exp(float(kt_block(np.array([2.0]), np.array([1.0]))[0])), 0.5 * 0.75 * (0.5 / 3))


class Brute:
    """The same tree by recursion over dictionaries."""

    def __init__(self, words):
        self.counts = {}
        for word, n in words.items():
            for context, byte in self.coded(word):
                for k in range(8):
                    for depth in range(DEPTH + 1):
                        c = self.counts.setdefault((context[len(context) - depth:], 1 << k | byte >> (8 - k)), [0, 0])
                        c[byte >> (7 - k) & 1] += n
        self.children = {}
        for context, node in self.counts:
            if context:
                self.children.setdefault((context[1:], node), []).append((context, node))
        self.memo = {}

    @staticmethod
    def coded(word):
        data = bytes([32]) * DEPTH + word + (b"" if word == b"\n" else b" ")
        return [(data[k - DEPTH:k], data[k]) for k in range(DEPTH, len(data))]

    def weighted(self, key):
        if key not in self.memo:
            a, b = self.counts[key]
            estimate = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
            if len(key[0]) == DEPTH:
                self.memo[key] = (estimate, 1.0)
            else:
                below = sum(self.weighted(c)[0] for c in self.children[key])
                total = np.logaddexp(estimate, below) + math.log(.5)
                self.memo[key] = (total, math.exp(estimate + math.log(.5) - total))
        return self.memo[key]

    def log10(self, word):
        total = 0.0
        for context, byte in self.coded(word):
            for k in range(8):
                p, settled, share = 0.5, 0.0, 1.0
                for depth in range(DEPTH + 1):
                    key = (context[len(context) - depth:], 1 << k | byte >> (8 - k))
                    if sum(self.counts.get(key, (0, 0))):
                        a, b = self.counts[key]
                        one, stop = (b + .5) / (a + b + 1), self.weighted(key)[1]
                        p = settled + share * one
                        settled, share = settled + share * stop * one, share * (1 - stop)
                total += math.log10(p if byte >> (7 - k) & 1 else 1 - p)
        return total


def texts():
    stems = ["ba", "lo", "ké", "MI", "sun", "tor"]
    made = ["".join(p) for p in itertools.product(stems, repeat=2)]
    rows = [(k, " ".join(made[(k * j * j + j) % len(made)] for j in range(k % 23)), "a") for k in range(120)]
    return rows + [(500, None, "a"), (501, "", None), (502, " \t\n", "a"), (503, "unseen wörds here\x00", "b"), (504, "ba " * 3000, "b"),
                   (7, "a repeated id", "a"), (7, "a repeated id", "a"), (None, "no id", "a")]


@pytest.mark.parametrize("chunk", [24_000_000, 900])
def test_counts_and_base_scores(documents, monkeypatch, chunk):
    """What is counted of the tokens, and the score of their counts alone."""
    monkeypatch.setattr(ctw, "CHUNK_BYTES", chunk)
    rows = texts()
    got = score_texts(documents(rows)).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = {b"\n": 0}
    for i, text, _ in rows:
        if not out(i):
            for token in tokens_of(text) + [b"\n"]:
                counts[token] = counts.get(token, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    wanted = []
    for i, text, _ in rows:
        tokens = tokens_of(text) + [b"\n"]
        base = sum(math.log10((counts.get(t, 0) + .5) / (total + .5 * (distinct + 1))) for t in tokens)
        wanted.append((repr(i), out(i), len(tokens), sum(counts.get(t, 0) > 0 for t in tokens), total, round(base, 6)))
    assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == sorted(wanted)


def test_probabilities_add_up():
    """All words of up to two letters over two letters, the rest below one."""
    counts = {b"ab": 5, b"b": 2, b"\n": 3}
    brute = Brute(counts)
    total = sum(10 ** brute.log10(w) for w in [b"\n", b"a", b"b", b"aa", b"ab", b"ba", b"bb"])
    assert 0.3 < total < 1


def test_empty_and_untrained(documents):
    assert score_texts(documents([])).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    row = score_texts(documents([(held, "ab", "a")])).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and math.isclose(row["score"], -32 * math.log10(2))


class TextBrute(Brute):
    """The recursion over whole texts: contexts reach across the words."""

    @staticmethod
    def coded(stream):
        data = bytes([32]) * DEPTH + stream
        return [(data[k - DEPTH:k], data[k]) for k in range(DEPTH, len(data))]


@pytest.mark.parametrize("small", [False, True])
def test_contexts_reach_across_words(documents, monkeypatch, small):
    if small:
        for name, value in (("CHUNK_BYTES", 900), ("GROUP_BYTES", 200), ("HELD_GRAMS", 50), ("BUCKET_GRAMS", 20)):
            monkeypatch.setattr(ctw, name, value)
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    held = [k for k in range(600, 700) if out(k)][:2]
    rows = texts() + [(held[0], "ba lo ké mi", "a"), (held[1], "mi ké lo ba", "a")]
    stream = lambda text: b" ".join([*tokens_of(text), b"\n"])
    counts = {}
    for i, text, _ in rows:
        counts[stream(text)] = counts.get(stream(text), 0) + (not out(i))
    brute = TextBrute(counts)
    got = score_texts(documents(rows)).collect()
    wanted = sorted((repr(i), len(stream(t)), brute.log10(stream(t))) for i, t, _ in rows)
    seen = sorted((repr(r["doc_id"]), r["n_bytes"], r["score"]) for r in got)
    assert len(seen) == len(wanted)
    for a, b in zip(seen, wanted):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-6)
    one, other = ([r["score"] for r in got if r["doc_id"] == k][0] for k in held)
    assert abs(one - other) > 1e-3


def test_texts_are_packed_once(documents, monkeypatch):
    """The tasks' chunks are written compressed, much smaller than the texts, and hold every one of them."""
    monkeypatch.setattr(ctw, "CHUNK_BYTES", 50_000)
    staged = {}
    stage = ctw.workspace

    def kept(df):
        work = stage(df)
        write = work.stage
        work.stage = lambda frame, name: staged.setdefault(name, write(frame, name))
        return work

    monkeypatch.setattr(ctw, "workspace", kept)
    rows = [(k, f"Word number {k} of a longer text " * 40, "a") for k in range(200)]
    assert score_texts(documents(rows)).count() == 200
    chunks = staged["chunks"].collect()
    assert sorted(i for c in chunks for i in c["doc_id"]) == list(range(200))
    assert len({c["chunk"] for c in chunks}) == len(chunks) > 1
    assert 4 * sum(len(c["packed"]) for c in chunks) < sum(len(t) for _, t, _ in rows)
