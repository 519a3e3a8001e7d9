import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from sluicebox.llm import repeats
from sluicebox.llm.repeats import anchors, bounded_prefixes, cut_repeats, first_strings, remove_repeats


def brute(rows, length):
    """Rows (doc_id, text) in order of doc_id."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        covered = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            string = raw[k:k + length]
            if string in seen:
                covered[k:k + length] = True
            seen.add(string)
        spans = sum(bool(c) and (k == 0 or not covered[k - 1]) for k, c in enumerate(covered))
        left = bytes(b for b, c in zip(raw, covered) if not c)
        out.append((doc_id, len(raw), int(covered.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("symbols,length", [(2, 9), (3, 20), (30, 5), (1, 12)])
def test_common_prefixes(symbols, length):
    rng = np.random.default_rng(symbols)
    text = np.concatenate([rng.integers(1, symbols + 1, 300), np.zeros(1, np.int64)])
    text[150:200] = text[20:70]
    order, common = bounded_prefixes(text, length)
    suffix = [tuple(text[k:k + length]) + (0,) * max(0, length - (len(text) - k)) for k in range(len(text))]
    assert [suffix[k] for k in order] == sorted(suffix)
    for k in range(1, len(order)):
        a, b = suffix[order[k - 1]], suffix[order[k]]
        shared = next((i for i in range(length) if a[i] != b[i]), length)
        assert common[k] == shared


def test_first_strings_are_first():
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(10, 30))) for _ in range(40)]
    keys = [np.array([k // 3 for k in range(40)]), np.zeros(40, np.int64), np.array([(k % 3) * 100 for k in range(40)])]
    got = first_strings(pieces, keys, 10)
    seen = set()
    for piece, kept in zip(pieces, got):
        for k, flag in enumerate(kept):
            assert flag == (piece[k:k + 10] not in seen)
            seen.add(piece[k:k + 10])


def test_anchor_depends_on_the_string_alone():
    rng = random.Random(1)
    raw = bytes(rng.choice(b"abcd ") for _ in range(700))
    raw = raw + b"xyz" + raw
    place, value = anchors(raw)
    for k in range(0, 600, 7):
        assert place[k] - k == place[k + 703] - k - 703 and value[k] == value[k + 703]


def test_anchors_of_long_texts_in_parts(monkeypatch):
    rng = random.Random(6)
    raw = bytes(rng.choice(b"abc ") for _ in range(3000)) + b"x" * 700
    whole = anchors(raw)
    monkeypatch.setattr(repeats, "_PLACES", np.uint64(511))
    parts = anchors(raw)
    assert (parts[0] - np.arange(len(parts[0])) >= 0).all() and (parts[0] - np.arange(len(parts[0])) <= 76).all()
    assert len(parts[0]) == len(whole[0])


def test_a_phrase_in_two_texts_is_no_common_anchor():
    rng = random.Random(8)
    word = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    phrase, passage = word(60), word(100)
    texts = [word(300) + phrase + word(300) for _ in range(20)]
    names = [set(anchors(raw)[1].tolist()) for raw in texts]
    assert len(set().union(*names)) == sum(map(len, names))
    a, b = (set(anchors(word(300) + passage + word(300))[1].tolist()) for _ in range(2))
    assert a & b


@pytest.mark.parametrize("length", [3, 24, 25, 40, 73, 100, 131])
def test_texts_looked_at_together(monkeypatch, length):
    rng = random.Random(length)
    word = lambda n: bytes(rng.choice(b"ab ") for _ in range(n))
    raws = [word(rng.randrange(400)) for _ in range(30)] + [b"", b"x" * 700, word(length), word(length - 1)]
    raws += raws[3:5] + [raws[3] + raws[4]]
    text, begin, end, name = repeats.text_runs(raws, length)
    names = {}
    for k, raw in enumerate(raws):
        b, e, place, n = repeats.anchor_runs(raw, length)
        here = text == k
        assert (begin[here].tolist(), end[here].tolist(), name[here].tolist()) == (b.tolist(), e.tolist(), n.tolist())
        assert [p for x, y in zip(b, e) for p in range(x, y)] == list(range(len(raw) - length + 1))
        for x, y, z in zip(b.tolist(), e.tolist(), n.tolist()):
            assert all(names.setdefault(raw[p:p + length], z) == z for p in range(x, y))
    monkeypatch.setattr(repeats, "_PLACES", np.uint64(1023))
    assert [len(raw) for raw in raws if len(raw) >= length] == [len(anchors(raw, length)[0]) + length - 1 for raw in raws if len(raw) >= length]


def test_runs_of_another_row_of_the_same_number():
    salt, other = 5, 6
    mark = [int(repeats._mark(s, 100)) << repeats._PLACE_BITS for s in (salt, other)]
    runs = [(mark[0] | 70) << 7 | 9, (mark[1] | 20) << 7 | 3, (mark[0] | 40) << 7 | 77, (mark[0] | 70) << 7 | 9]
    row = pa.array([runs], pa.list_(pa.int64()))[0]
    anchor, begin, n = repeats._flagged(pa.array([[11, 12, 13, 11]], pa.list_(pa.int64()))[0], row, salt, 100)
    assert (anchor.tolist(), begin.tolist(), n.tolist()) == ([13, 11], [40, 70], [77, 9])


@pytest.mark.parametrize("hot", [1000, 2])
def test_against_brute_force(documents, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "BIN_BYTES", 2000)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    passage = [" ".join(word() for _ in range(60)) for _ in range(4)]
    line = "the very common line, seventy bytes long or so, that many texts hold. "
    rows = []
    for k in range(45):
        parts = [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passage)[rng.randrange(40):])
        rows.append((k * 2, line.join(parts)))
    rows += [(200, rows[7][1]), (201, rows[7][1]), (202, rows[7][1][:-1]), (203, "x" * 400), (204, "ab" * 150), (205, None), (206, ""),
             (207, "x" * 99), (208, "x" * 100), (209, line * 9), (1, rows[3][1] + rows[3][1])]
    rng.shuffle(rows)
    got = sorted(map(tuple, remove_repeats(documents([(i, t, "a") for i, t in rows])).collect()))
    assert got == brute(rows, 100)


def test_edges_and_cut(documents):
    assert remove_repeats(documents([])).count() == 0
    long = " ".join(f"é{k}" for k in range(60))
    rows = [(1, long, "a"), (1, long, "a"), (2, long, None), (3, None, "b"), (4, "short", "b"), (5, "head " + long + " tail", "b"), (None, long, "b")]
    got = remove_repeats(documents(rows)).collect()
    assert len(got) == 7 and sorted(r["n_removed"] for r in got) == [0, 0, 0, 0] + [len(long.encode())] * 3
    docs = documents(rows)
    cut = cut_repeats(docs)
    assert cut.columns == docs.columns and cut.dtypes == docs.dtypes
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    assert texts[5] == ("head  tail", 10) and texts[2] == ("", 0) and texts[3] == (None, None) and texts[None] == ("", 0)


def test_rows_without_id_take_their_own_strings_only(documents, monkeypatch):
    real_remove, real_pieces = repeats._remove, repeats._pieces

    def own_only(real, name):
        def make(*args):
            inner = real(*args)

            def run(batches):
                def checked():
                    for batch in batches:
                        for salt, listed in zip(batch.column("salt").to_pylist(), batch.column(name).to_pylist()):
                            if any(w["salt"] != salt for w in listed or []):
                                raise ValueError("strings of another row")
                        yield batch
                yield from inner(checked())
            return run
        return make

    monkeypatch.setattr(repeats, "_remove", own_only(real_remove, "kept"))
    monkeypatch.setattr(repeats, "_pieces", own_only(real_pieces, "wanted"))
    passage = " ".join(f"shared{j}" for j in range(40))
    rows = [(None, f"{k} " + " ".join(f"own{k}x{j}" for j in range(30)) + " " + passage, "a") for k in range(30)]
    got = remove_repeats(documents(rows)).collect()
    assert len(got) == 30 and sorted(r["n_removed"] > 0 for r in got) == [False] + [True] * 29
