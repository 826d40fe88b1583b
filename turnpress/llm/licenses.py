"""License scan: templates with optional and replaceable regions, compiled to automata over words.

A template is plain wording. ``[[ ... ]]`` may be left out; ``{{2-5}}`` stands for two to five
words of any kind, ``{{1-2 number}}`` for one or two numbers, ``{{a | b}}`` for one of the words. All
else is mandatory and must be met word for word. A template becomes a nondeterministic automaton,
which is made deterministic as far as texts walk through it. It is tried where one of its first
words stands, and only in texts that hold its longest run of mandatory words, which a text without
a match may lack and one with a match cannot. Matches are leftmost, longest and do not overlap.

Base phrases are looked for on their own, at every place, and need no template.

Defined results: NULL is an empty text, without words or matches and with score 0. Every row is
scanned by itself, whole, so repeated rows get equal results; other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.llm.common import texts, with_batch_column

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
"""A word, after A-Z are lower-cased."""

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of public licence notices and texts.
TEMPLATES = {
    "gpl-notice": """
        under the [[terms of the]] gnu {{lesser | affero | library | general}} [[general]] public license
        [[version {{1-2 number}} [[or [[at your option]] [[any]] later [[version]]]]]]""",
    "gpl-header": """
        this {{1-3}} is free software you can redistribute it and or modify it under the terms of the
        gnu [[lesser]] [[affero]] general public license as published by the free software foundation
        [[either]] version {{1-2 number}} of the license [[or at your option any later version]]""",
    "apache-notice": "under the [[terms of the]] apache license [[version {{1-2 number}}]]",
    "apache-header": """
        licensed under the apache license version 2 0 the license you may not use this file except in compliance
        with the license you may obtain a copy of the license at http www apache org licenses license 2 0
        [[unless required by applicable law or agreed to in writing software distributed under the license is
        distributed on an as is basis without warranties or conditions of any kind either express or implied]]""",
    "mit-notice": "{{released | licensed | distributed | available}} under the [[terms of the]] mit license",
    "mit-text": """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation
        the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to
        permit persons to whom the software is furnished to do so subject to the following conditions
        the above copyright notice and this permission notice [[including the next paragraph]] shall be included in
        all copies or substantial portions of the software
        [[the software is provided as is without warranty of any kind express or implied including but not limited
        to the warranties of merchantability fitness for a particular purpose and noninfringement]]""",
    "isc-text": """
        permission to use copy modify and {{and | or}} distribute this software for any purpose with or without fee
        is hereby granted provided that the above copyright notice and this permission notice appear in all copies""",
    "bsd-text": """
        redistribution and use in source and binary forms with or without modification are permitted provided that
        the following conditions are met [[1]] redistributions of source code must retain the above copyright
        notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must
        reproduce the above copyright notice this list of conditions and the following disclaimer in the
        documentation and or other materials provided with the distribution
        [[[[3]] neither the name of {{1-12}} may be used to endorse or promote products derived from this software
        without specific prior written permission]]""",
    "cc-by-nc-notice": "under [[{{a | the}}]] cc by nc [[{{sa | nd}}]] [[{{1-2 number}}]] [[license]]",
    "cc-by-sa-notice": "under [[{{a | the}}]] cc by sa [[{{1-2 number}}]] [[license]]",
    "cc-by-nd-notice": "under [[{{a | the}}]] cc by nd [[{{1-2 number}}]] [[license]]",
    "cc-attribution": """
        licensed under {{a | the}} creative commons attribution [[{{noncommercial | sharealike | noderivatives}}]]
        [[{{sharealike | noderivatives}}]] {{0-2 number}} [[{{international | unported | generic}}]] license""",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "public-domain": "{{is | been | are}} [[hereby]] {{released | placed | dedicated}} {{into | in | to}} the public domain",
}

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

ANY, NUMBER = "*", "#"


@dataclass(frozen=True)
class Region:
    """``low`` to ``high`` words of a kind: one of ``words``, or all of class ``ANY`` or ``NUMBER``."""

    low: int
    high: int
    words: tuple[str, ...]


def parse(markup: str) -> list:
    """Nested lists: a text is a word, a list an optional region, a ``Region`` a replaceable one."""
    spaced = markup
    for mark in ("[[", "]]", "{{", "}}"):
        spaced = spaced.replace(mark, f" {mark} ")
    tokens, stack = spaced.split(), [[]]
    at = 0
    while at < len(tokens):
        token = tokens[at]
        if token == "[[":
            stack.append([])
        elif token == "]]":
            part = stack.pop()
            stack[-1].append(part)
        elif token == "{{":
            end = tokens.index("}}", at)
            stack[-1].append(_region(tokens[at + 1 : end]))
            at = end
        else:
            stack[-1].append(token)
        at += 1
    if len(stack) != 1:
        raise ValueError("an optional region does not end")
    return stack[0]


def _region(said: list[str]) -> Region:
    if "-" in said[0] and said[0].replace("-", "").isdigit():
        low, high = map(int, said[0].split("-"))
        return Region(low, high, (NUMBER if said[1:] == ["number"] else ANY,))
    return Region(1, 1, tuple(w for w in said if w != "|"))


def mandatory(parts: list) -> int:
    """Words that every match holds as written."""
    return sum(isinstance(p, str) for p in parts)


def anchor(parts: list) -> str:
    """The longest run of mandatory words."""
    best, now = [], []
    for p in [*parts, None]:
        now = [*now, p] if isinstance(p, str) else []
        best = max(best, now, key=len)
    return " ".join(best)


class Automaton:
    """A template's automaton over words; sets of its states are numbered as they are first met."""

    def __init__(self, parts: list):
        self.steps: list[list[tuple[str, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        self.end = self._sequence(parts, 0)
        self.known = {w for steps in self.steps for w, _ in steps} - {ANY, NUMBER}
        self.sets: list[frozenset[int]] = []
        self.number: dict[frozenset[int], int] = {}
        self.next: dict[tuple[int, str], int] = {}
        self.first = {w for s in self._closed({0}) for w, _ in self.steps[s]}
        if {ANY, NUMBER} & self.first or self.end in self._closed({0}):
            raise ValueError("a template begins with a word and is not empty")
        self.start = self._numbered({0})

    def _state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _sequence(self, parts: list, at: int) -> int:
        for p in parts:
            if isinstance(p, list):
                begin, at = at, self._sequence(p, at)
                self.free[begin].append(at)
                continue
            region = p if isinstance(p, Region) else Region(1, 1, (p,))
            skips = []
            for i in range(region.high):
                if i >= region.low:
                    skips.append(at)
                to = self._state()
                self.steps[at] += [(w, to) for w in region.words]
                at = to
            for s in skips:
                self.free[s].append(at)
        # An end of its own, so that nothing skipped to it is entered twice.
        to = self._state()
        self.free[at].append(to)
        return to

    def _closed(self, states: set[int]) -> frozenset[int]:
        seen, left = set(states), list(states)
        while left:
            for s in self.free[left.pop()]:
                if s not in seen:
                    seen.add(s)
                    left.append(s)
        return frozenset(seen)

    def _numbered(self, states: set[int]) -> int:
        closed = self._closed(states)
        if closed not in self.number:
            self.number[closed] = len(self.sets)
            self.sets.append(closed)
        return self.number[closed]

    def step(self, state: int, word: str) -> int:
        """The next set of states; the empty set is a number too."""
        kind = word if word in self.known else NUMBER if word.isascii() and word.isdigit() else ANY
        key = (state, kind)
        if key not in self.next:
            is_number = word.isascii() and word.isdigit()
            taken = {
                to for s in self.sets[state] for w, to in self.steps[s] if w == word or w == ANY or (w == NUMBER and is_number)
            }
            self.next[key] = self._numbered(taken)
        return self.next[key]

    def longest(self, words: list[str], at: int) -> int:
        """End of the longest match that begins at a word, or -1."""
        state, end = self.start, -1
        while self.sets[state]:
            if self.end in self.sets[state]:
                end = at
            if at == len(words):
                break
            state = self.step(state, words[at])
            at += 1
        return end


@dataclass
class Scanner:
    """Compiled templates and the base phrases."""

    templates: tuple[tuple[str, str], ...]
    base: tuple[tuple[str, str], ...]

    def __post_init__(self):
        self.phrases = [(f" {phrase} ".encode(), label) for phrase, label in self.base]
        parts = [(label, parse(markup)) for label, markup in self.templates]
        if not all(anchor(p) for _, p in parts):
            raise ValueError("a template needs a mandatory word")
        self.automata = [(f" {anchor(p)} ".encode(), label, Automaton(p)) for label, p in parts]

    def scan(self, text: bytes) -> dict:
        words = text.translate(_TABLE).split()
        line = b" " + b" ".join(words) + b" "
        places, found, read = [], [], None
        for phrase, label in self.phrases:
            at, counted, word = line.find(phrase), 0, 0
            while at >= 0:
                word += line.count(b" ", counted, at)
                counted = at
                places.append({"label": label, "word": word})
                at = line.find(phrase, at + 1)
        for held, label, automaton in self.automata:
            if held not in line:
                continue
            read = read if read is not None else [w.decode() for w in words]
            at = 0
            while at < len(read):
                end = automaton.longest(read, at) if read[at] in automaton.first else -1
                if end > at:
                    found.append({"label": label, "word": at, "end": end})
                at = max(end, at + 1)
        return {"n_words": len(words), "base": places, "found": found}


@lru_cache(maxsize=8)
def scanner(templates: tuple[tuple[str, str], ...], base: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(templates, base)


def _spans(*names: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("label", T.StringType()), *(T.StructField(n, T.LongType()) for n in names)]))


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("base", _spans("word")), T.StructField("found", _spans("word", "end")),
])


def scan(
    docs: DataFrame, text: str = "text", out: str = "licenses", templates: dict[str, str] | None = None,
    base: dict[str, str] | None = None,
) -> DataFrame:
    """All columns and ``out``: words, the places of base phrases, and the spans that templates accept."""
    from pyspark.sql.pandas.types import to_arrow_type

    given = tuple((TEMPLATES if templates is None else templates).items()), tuple((BASE if base is None else base).items())
    scanner(*given)  # an error in a template shows here and not on an executor
    kind = to_arrow_type(RESULT)

    def made(batch: pa.RecordBatch) -> pa.Array:
        own = scanner(*given)
        return pa.array([own.scan(value) for value in texts(batch, text)], kind)

    return with_batch_column(docs, out, RESULT, made)


def labels(found: Column) -> Column:
    """Distinct labels, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(found)), ",")


def score(result: Column) -> Column:
    """Weight of the best evidence, k / (k + 4) for k mandatory words met; 0 without any.

    Two words of a base phrase count a third; a whole licence text comes near 1.
    """
    sizes = {**{label: len(phrase.split()) for phrase, label in BASE.items()}, **{label: mandatory(parse(m)) for label, m in TEMPLATES.items()}}
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    met = F.concat(result["base"]["label"], result["found"]["label"])
    k = F.coalesce(F.array_max(F.transform(met, lambda label: size[label])), F.lit(0))
    return k / (k + 4.0)
