"""License scans by patience alignment.

A template covers a stretch of text as far as its words can be aligned with it in order. Words that
are unique to both the stretch and the template are anchors; the longest increasing subsequence of
the anchors' places is taken, and the gaps between them are aligned in the same way. A gap without
anchors is aligned by its longest common subsequence. Coverage is the aligned part of the template.

Stretches are windows twice as long as the template, so a notice may hold as many inserted words as
it has words of its own. A window begins at every word that can be the first one aligned, which is any
of those the template begins with, as far as coverage lets it lack them; so where a notice stands in
the text does not matter. Most texts and windows are passed over by counts kept while the window
moves: one that lacks more words than coverage allows cannot reach it, the words that name the
license must all be there, and one that cannot beat the best so far is not aligned. Whole texts are
read, in one pass without a shuffle.

Some notices differ only by words of their name. A template whose words all occur in a sibling's is not
found where one of the words that name the sibling stands inside the aligned stretch, so "GNU Lesser
General Public License" is not the general one; a sentence that names both yields the longer only.

Defined results: a null or empty text has no license. Of several windows the best counts, then the
first; of several licenses the best covered is ``license``, then the longer, then the first by name,
and all are listed. A rights notice comes after every license. Rows are scanned each for itself. An empty table gives an empty result. Columns
beyond ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from starbrook.llm.common import id_and_text, steps, table

COVERAGE = 0.8
_WORD = re.compile(r"\w+")

# fixed values: name, words that must be aligned, text
LICENSES = (
    ("Apache-2.0", "apache 2 0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "mit", "Released under the MIT License."),
    ("GPL-3.0", "gnu 3", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "cc by nc 4 0", "Licensed under CC BY-NC 4.0."),
    (
        "MIT",
        "permission granted charge",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    (
        "ISC",
        "permission fee",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
    ),
    (
        "BSD-2-Clause",
        "redistribution binary",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "Apache-2.0",
        "apache 2 0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "GPL-3.0",
        "gnu 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "gnu lesser 3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "gnu affero 3", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL-2.0", "gnu 2", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "cc by 4 0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "cc by sa 4 0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "cc by nd 4 0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "cc by nc sa 4 0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "cc by nc nd 4 0", "Licensed under CC BY-NC-ND 4.0."),
    (
        "LGPL-3.0",
        "gnu lesser 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "gnu affero 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    ("All-Rights-Reserved", "all rights reserved", "All rights reserved."),
)
# notices that grant nothing; a license beside them is the document's license
RIGHTS_NOTICES = frozenset({"All-Rights-Reserved"})


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(places: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence, by piles."""
    tops: list[int] = []
    pile_of: list[int] = []
    below: list[int] = []
    for i, place in enumerate(places):
        pile = bisect_left(tops, place)
        if pile == len(tops):
            tops.append(place)
            pile_of.append(i)
        else:
            tops[pile] = place
            pile_of[pile] = i
        below.append(pile_of[pile - 1] if pile else -1)
    chain, at = [], pile_of[-1] if pile_of else -1
    while at >= 0:
        chain.append(at)
        at = below[at]
    return chain[::-1]


def _common(a: list[str], b: list[str], i: int, j: int) -> list[tuple[int, int]]:
    """A longest common subsequence, as pairs of places from (i, j) on."""
    if not a or not b:
        return []
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for x in range(len(a) - 1, -1, -1):
        row, under = length[x], length[x + 1]
        for y in range(len(b) - 1, -1, -1):
            row[y] = under[y + 1] + 1 if a[x] == b[y] else max(under[y], row[y + 1])
    pairs, x, y = [], 0, 0
    while x < len(a) and y < len(b):
        if a[x] == b[y]:
            pairs.append((i + x, j + y))
            x, y = x + 1, y + 1
        elif length[x + 1][y] >= length[x][y + 1]:
            x += 1
        else:
            y += 1
    return pairs


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of the words of ``a`` and ``b`` that patience alignment matches, in order."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        part, other = a[a0:a1], b[b0:b1]
        if not part or not other:
            continue
        times, other_times = Counter(part), Counter(other)
        place = {w: i for i, w in enumerate(part) if times[w] == 1}
        shared = [(place[w], j) for j, w in enumerate(other) if other_times[w] == 1 and w in place]
        if not shared:
            matched.extend(_common(part, other, a0, b0))
            continue
        anchors = [shared[k] for k in increasing([i for i, _ in shared])]
        i0, j0 = 0, 0
        for i, j in [*anchors, (len(part), len(other))]:
            todo.append((a0 + i0, a0 + i, b0 + j0, b0 + j))
            i0, j0 = i + 1, j + 1
        matched.extend((a0 + i, b0 + j) for i, j in anchors)
    return sorted(matched)


@dataclass
class Found:
    name: str
    size: int
    coverage: float
    first: int  # words of the text from here
    last: int  # to here


class Template:
    def __init__(self, name: str, required: str, text: str, least: float = COVERAGE):
        self.name, self.words, self.least = name, words_of(text), least
        self.counts = Counter(self.words)
        self.required = frozenset(required.split())
        size = len(self.words)
        self.missing = size - math.ceil(least * size - 1e-9)
        self.head = frozenset(self.words[: self.missing + 1])
        self.foreign: frozenset[str] = frozenset()  # words that name a sibling

    def _reachable(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """Where windows that may be covered begin, and how many of the template's words they lack."""
        places = [i for i, w in enumerate(words) if w in self.counts]
        there = dict.fromkeys(self.counts, 0)
        lacking, end = len(self.words), 0
        for start in places:
            while end < len(places) and places[end] < start + 2 * len(self.words):
                word = words[places[end]]
                lacking -= there[word] < self.counts[word]
                there[word] += 1
                end += 1
            first = words[start]
            if first in self.head and lacking <= self.missing and all(there[w] for w in self.required):
                yield start, lacking
            there[first] -= 1
            lacking += there[first] < self.counts[first]

    def find(self, words: list[str], present: set[str]) -> Found | None:
        """The best window of a text whose words in any template are ``present``."""
        lacking = sum(n for w, n in self.counts.items() if w not in present)
        if not self.required <= present or lacking > self.missing:
            return None
        size, best = len(self.words), None
        for start, lacking in self._reachable(words):
            if best is not None and (size - lacking) / size <= best.coverage:
                continue
            pairs = align(words[start : start + 2 * size], self.words)
            coverage = len(pairs) / size
            named = self.required <= {self.words[j] for _, j in pairs}
            if named and coverage >= self.least and (best is None or coverage > best.coverage):
                first, last = start + pairs[0][0], start + pairs[-1][0]
                if self.foreign.isdisjoint(words[first : last + 1]):
                    best = Found(self.name, size, coverage, first, last)
        return best


class Scanner:
    def __init__(self, licenses: tuple[tuple[str, str, str], ...]):
        self.templates = [Template(*x) for x in licenses]
        self.vocabulary = {w for t in self.templates for w in t.counts}
        for t in self.templates:
            siblings = [s for s in self.templates if s.name != t.name and t.counts.keys() < s.counts.keys()]
            t.foreign = frozenset(w for s in siblings for w in s.required) - t.counts.keys()

    def scan(self, text: str) -> list[Found]:
        """The licenses of a text, the best covered first, each once."""
        words = words_of(text)
        present = self.vocabulary.intersection(words)
        found = [f for t in self.templates if (f := t.find(words, present))]
        found.sort(key=lambda f: (f.name in RIGHTS_NOTICES, -f.coverage, -f.size, f.name))
        return list({f.name: f for f in reversed(found)}.values())[::-1]


SCHEMA = "doc_id bigint, license string, coverage double, first_word bigint, last_word bigint, licenses string"


def scan(docs: DataFrame, licenses: tuple[tuple[str, str, str], ...] = LICENSES) -> DataFrame:
    """One row a document: its best covered license, by how much, where, and all by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scanner(licenses)
        for batch in batches:
            for ids, texts in steps(batch["doc_id"], batch["text"]):
                rows = [_row(own.scan(t)) for t in texts]
                license_, coverage, first, last, every = zip(*rows, strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(ids, pa.int64()),
                        "license": pa.array(license_, pa.string()),
                        "coverage": pa.array(coverage, pa.float64()),
                        "first_word": pa.array(first, pa.int64()),
                        "last_word": pa.array(last, pa.int64()),
                        "licenses": pa.array(every, pa.string()),
                    }
                )

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def _row(found: list[Found]) -> tuple:
    if not found:
        return None, 0.0, None, None, ""
    best = found[0]
    return best.name, best.coverage, best.first, best.last, ",".join(sorted(f.name for f in found))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
