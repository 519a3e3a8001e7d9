import re

from sluicebox.llm.templates import AUTOMATA, PHRASES, Automaton, license_scan, scan, words_of


def test_words_match_the_pattern():
    for text in ("A-b c1_2 é[ü] `x`{y}\x7f\x80 日本, 7", "", " ., ", "x" * 40):
        want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text))
        assert [w.decode() for w in words_of(text)] == want


def test_automaton_accepts_mandatory_wording_only():
    automaton = Automaton("one two [[or three]] four <<gap:2>> end")
    at = lambda text: automaton.longest(text.encode().split(), 0)
    assert at("one two four end") == 4
    assert at("one two or three four x y end tail") == 8
    assert at("one two four x y z end") is None
    assert at("one two or four end") is None
    assert at("one two extra four end") is None
    assert at("two four end") is None


def test_longest_and_several_paths():
    automaton = Automaton("[[a]] b <<any:1>> b")
    assert automaton.longest(b"b b b".split(), 0) == 3
    assert automaton.longest(b"a b b".split(), 0) == 3


def brute(text):
    w = [x for x in words_of(text)]
    places = [k for k in range(len(w)) for p in PHRASES if w[k:k + len(p.split())] == [x.encode() for x in p.split()]]
    return len(places), min(places, default=None), max(places, default=None)


def test_scan():
    for text in ("MIT License, MIT license mit-license", "x Licensed under the Apache License, Version 2.0.", "cc by cc by-nc 4.0",
                 "GNU General Public License GNU general public LICENSE", "", None, "gnu general public", "word " * 5000 + "CC BY"):
        got = scan(text)
        assert got[1:4] == brute(text)
        assert 0 <= got[6] <= 1
    assert scan("Licensed under the Apache License, Version 2.0.")[4:6] == ("apache", "apache,apache-2.0-notice")
    assert "apache-2.0-notice" not in scan("Licensed under some Apache License, Version 2.0.")[5]
    assert all(a.starts for a in AUTOMATA.values())


def test_query_rows(documents):
    rows = [(1, None, "a"), (1, None, "a"), (2, "MIT License", None), (None, "", "b")]
    got = license_scan(documents(rows)).collect()
    assert len(got) == 4 and sorted(r["n_base"] for r in got) == [0, 0, 0, 1]
    assert license_scan(documents([])).count() == 0
