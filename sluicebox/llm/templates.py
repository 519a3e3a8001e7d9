"""License scans by template-markup matching.

A template is wording with optional and replaceable regions.  It is compiled
into an automaton over tokens; a place is accepted only if all mandatory words
stand there, in order and with nothing between them that the markup does not
allow.  Every word of every text is tokenised; the automata run from the places
where a template's first two words stand.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sluicebox.llm.common import table

# Fixed values of the contract: phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license wording, with [[optional]] and <<replaceable:words>> regions.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 [[(the License)]] [[you may not use this file except in compliance with the License]]",
    "gpl-notice": "This program is free software [[you can redistribute it and or modify it]] under the terms of the GNU General Public License as published by the Free Software Foundation <<version:12>> any later version",
    "gpl-version": "GNU General Public License [[as published by the Free Software Foundation]] [[either]] version <<number:1>> [[of the License]]",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files [[(the Software)]] to deal in <<the thing:2>> without restriction",
    "mit-notice": "[[Released]] under the MIT License",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "isc-text": "Permission to use, copy, modify, and [[or]] distribute this software for any purpose with or without fee is hereby granted",
    "cc-by-version": "CC BY [[SA]] [[NC]] [[ND]] <<number:1>> 0",
}

_NOT_WORD = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
#: Other than word bytes become blanks, A-Z become a-z.
_WORDS = bytes(32 if b in _NOT_WORD else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


class Automaton:
    """Token automaton of one template: ``longest(words, at)`` is the end of the longest accepted run, or None."""

    def __init__(self, markup: str):
        self.steps: list[dict[bytes, int]] = [{}]
        self.wild: list[int | None] = [None]
        self.free: list[list[int]] = [[]]
        at = 0
        for kind, value in self._parse(markup):
            if kind == "words":
                at = self._words(at, value)
            elif kind == "optional":
                end = self._words(at, value)
                self.free[at].append(end)
                at = end
            else:
                entry = [at]
                for _ in range(value):
                    new = self._state()
                    self.wild[at] = new
                    at = new
                    entry.append(at)
                for state in entry[:-1]:
                    self.free[state].append(at)
        self.end = at
        self.closure = [self._closed(s) for s in range(len(self.steps))]
        starts = sorted({w for s in self.closure[0] for w in self.steps[s]})
        self.starts = {(w, v) for w in starts for s in self.closure[0] if w in self.steps[s]
                       for t in self.closure[self.steps[s][w]] for v in self.steps[t]}

    @staticmethod
    def _parse(markup: str):
        for part in re.findall(r"\[\[.*?\]\]|<<.*?>>|[^\[<]+", markup):
            if part.startswith("<<"):
                yield "replaceable", int(part.strip("<>").rpartition(":")[2])
            elif words := words_of(part):
                yield ("optional" if part.startswith("[[") else "words"), words

    def _state(self) -> int:
        self.steps.append({})
        self.wild.append(None)
        self.free.append([])
        return len(self.steps) - 1

    def _words(self, at: int, words: list[bytes]) -> int:
        for word in words:
            new = self._state()
            self.steps[at][word] = new
            at = new
        return at

    def _closed(self, state: int) -> tuple[int, ...]:
        seen, todo = {state}, [state]
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return tuple(sorted(seen))

    def longest(self, words: list[bytes], at: int) -> int | None:
        active, end = set(self.closure[0]), None
        for k in range(at, len(words)):
            after = set()
            for s in active:
                for t in (self.steps[s].get(words[k]), self.wild[s]):
                    if t is not None:
                        after.update(self.closure[t])
            if not after:
                break
            active = after
            if self.end in active:
                end = k + 1
        return end


AUTOMATA = {label: Automaton(markup) for label, markup in TEMPLATES.items()}
#: First two words of a template, and the templates that can begin with them.
_STARTS: dict[tuple[bytes, bytes], list[str]] = {}
for _label, _automaton in AUTOMATA.items():
    for _pair in sorted(_automaton.starts):
        _STARTS.setdefault(_pair, []).append(_label)
_SECOND: dict[bytes, set[bytes]] = {}
for _one, _two in _STARTS:
    _SECOND.setdefault(_one, set()).add(_two)
_PHRASES = [(b" " + p.encode() + b" ", len(p.split()), label) for p, label in PHRASES.items()]
_STARTED = [b" " + a + b" " + b + b" " for a, b in _STARTS]


def phrase_places(line: bytes) -> list[tuple[int, int, str]]:
    """(first word, words, label) of all places of the phrases in words joined by blanks, with blanks at both ends."""
    found = []
    for phrase, length, label in _PHRASES:
        at = line.find(phrase)
        while at >= 0:
            found.append((line.count(b" ", 0, at), length, label))
            at = line.find(phrase, at + 1)
    return found


def template_places(words: list[bytes]) -> list[tuple[int, int, str]]:
    """(first word, words, label) of the accepted places; of one template, the longest from each start."""
    found = []
    for k in range(len(words) - 1):
        if words[k] in _SECOND and words[k + 1] in _SECOND[words[k]]:
            for label in _STARTS[words[k], words[k + 1]]:
                end = AUTOMATA[label].longest(words, k)
                if end is not None:
                    found.append((k, end - k, label))
    return found


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    words = words_of(text)
    line = b" " + b" ".join(words) + b" "
    base = phrase_places(line)
    places = base + (template_places(words) if any(s in line for s in _STARTED) else [])
    covered = set()
    for start, length, _ in places:
        covered.update(range(start, start + length))
    starts = [s for s, _, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, _, x in base})), ",".join(sorted({x for _, _, x in places})),
            len(covered) / len(words) if words else 0.0)


_SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
           "base_labels string, labels string, score double")
_ARROW = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")],
                    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [scan(text.as_py()) for text in batch.column("text")]
        columns = list(zip(*rows)) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), *[pa.array(c, f.type) for c, f in zip(columns, list(_ARROW)[1:])]], schema=_ARROW)


def license_scan(documents: DataFrame) -> DataFrame:
    """Base phrases and templates of every whole text; score is the share of words they cover.

    One row per input row, rows that repeat an id included.  Null and empty
    texts have no words, no labels and score 0.  Overlapping places all count.
    An empty table gives no rows; only doc_id and text are read.
    """
    return documents.select("doc_id", "text").mapInArrow(_scan, _SCHEMA)


def op6_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
