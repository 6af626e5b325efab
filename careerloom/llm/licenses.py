"""License scans by patience alignment of documents with license templates.

A text is aligned with a template on the words that occur once in both: the longest run of them
that is in order in both (the longest increasing subsequence) are anchors, and the
gaps between anchors are aligned in the same way. Coverage is the share of the template's
words that are aligned.

Licenses differ in few words (a version, a clause), so a template may name deciding phrases: they
must be found whole and in order, and are anchors before all others. Barred phrases must not lie within the match.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Notice(NamedTuple):
    """A template: its text, the phrases of it that decide, in their order, and phrases that rule it out."""

    text: str
    deciding: tuple[str, ...] = ()
    barred: tuple[str, ...] = ()


MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED."
)


def free_software(kind: str, version: str) -> Notice:
    """The notice that the licenses of the GNU family ask for in each file."""
    text = (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {kind} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version."
    )
    return Notice(text, (kind, f"version {version} of the License"))


# Usual license notices and texts, by SPDX name.
TEMPLATES = {
    "MIT": Notice("Released under the MIT License.", ("MIT License",)),
    "ISC": Notice("Released under the ISC License.", ("ISC License",)),
    "BSD-2-Clause": Notice("Released under the BSD 2-Clause License.", ("BSD 2-Clause License",)),
    "BSD-3-Clause": Notice("Released under the BSD 3-Clause License.", ("BSD 3-Clause License",)),
    "Apache-1.1": Notice("Licensed under the Apache License, Version 1.1.", ("Apache License, Version 1.1",)),
    "Apache-2.0": Notice("Licensed under the Apache License, Version 2.0.", ("Apache License, Version 2.0",)),
    "GPL-2.0": Notice(
        "This work is licensed under the GNU General Public License, version 2.", ("GNU General Public License, version 2",)
    ),
    "GPL-3.0": Notice(
        "This work is licensed under the GNU General Public License, version 3.", ("GNU General Public License, version 3",)
    ),
    "LGPL-2.1": Notice(
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        ("GNU Lesser General Public License, version 2.1",),
    ),
    "LGPL-3.0": Notice(
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        ("GNU Lesser General Public License, version 3",),
    ),
    "AGPL-3.0": Notice(
        "This work is licensed under the GNU Affero General Public License, version 3.",
        ("GNU Affero General Public License, version 3",),
    ),
    "MPL-2.0": Notice(
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        ("Mozilla Public License, v. 2.0",),
    ),
    "CC-BY-4.0": Notice("Licensed under CC BY 4.0.", ("CC BY 4.0",)),
    "CC-BY-SA-4.0": Notice("Licensed under CC BY-SA 4.0.", ("CC BY-SA 4.0",)),
    "CC-BY-NC-4.0": Notice("Licensed under CC BY-NC 4.0.", ("CC BY-NC 4.0",)),
    "CC-BY-ND-4.0": Notice("Licensed under CC BY-ND 4.0.", ("CC BY-ND 4.0",)),
    "CC-BY-NC-SA-4.0": Notice("Licensed under CC BY-NC-SA 4.0.", ("CC BY-NC-SA 4.0",)),
    "CC-BY-NC-ND-4.0": Notice("Licensed under CC BY-NC-ND 4.0.", ("CC BY-NC-ND 4.0",)),
    "CC0-1.0": Notice("Released under CC0 1.0 Universal.", ("CC0 1.0",)),
    "Unlicense": Notice(
        "This is free and unencumbered software released into the public domain.", ("free and unencumbered software",)
    ),
    "MIT-text": Notice(MIT_GRANT),
    "ISC-text": Notice(
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("provided that the above copyright notice and this permission notice",),
    ),
    "BSD-2-Clause-text": Notice(
        f"{BSD_CLAUSES} {BSD_DISCLAIMER}", ("Redistributions in binary form",), ("endorse or promote products",)
    ),
    "BSD-3-Clause-text": Notice(
        f"{BSD_CLAUSES} {BSD_NAMES} {BSD_DISCLAIMER}", ("Redistributions in binary form", "endorse or promote products")
    ),
    "Apache-2.0-header": Notice(
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-2.0-header": free_software("GNU General Public License", "2"),
    "GPL-3.0-header": free_software("GNU General Public License", "3"),
    "LGPL-3.0-header": free_software("GNU Lesser General Public License", "3"),
    "AGPL-3.0-header": free_software("GNU Affero General Public License", "3"),
}
#: Least share of a template's words that are aligned, and of the words between the first and last of them.
COVERAGE, DENSITY = 0.8, 0.5
WORD = re.compile(r"\w+(?:[.\-]\w+)*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        at = bisect_left(tails, v)
        before.append(ends[at - 1] if at else -1)
        tails[at : at + 1] = [v]
        ends[at : at + 1] = [i]
    found, i = [], ends[-1] if ends else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def align(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Pairs of places (in a, in b) of equal words, in order in both."""
    found: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        # Equal words at both ends need no anchor.
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        n_a, n_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if n_b[w] == 1}
        anchors = [(i, place[a[i]]) for i in range(a0, a1) if n_a[a[i]] == 1 and a[i] in place]
        anchors = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        found += anchors
        if anchors:
            last = (a0 - 1, b0 - 1)
            for i, j in [*anchors, (a1, b1)]:
                if i > last[0] + 1 and j > last[1] + 1:
                    gaps.append((last[0] + 1, i, last[1] + 1, j))
                last = (i, j)
    return sorted(found)


def places_of(phrase: Sequence[str], words: Sequence[str], start: int = 0, end: int | None = None) -> Iterator[int]:
    """Where a phrase begins in words[start:end]."""
    end, n = len(words) if end is None else end, len(phrase)
    while True:
        try:
            start = words.index(phrase[0], start, max(start, end - n + 1))
        except ValueError:
            return
        if words[start : start + n] == phrase:
            yield start
        start += 1


class Template:
    """A template with the words that any match holds: its deciding phrases, or one of its rare words."""

    def __init__(self, name: str, notice: Notice, coverage: float):
        self.name, self.words, self.coverage = name, words_of(notice.text), coverage
        self.needed = -int(-coverage * len(self.words) // 1)
        self.reach = int(len(self.words) / DENSITY) + 1
        self.barred = [words_of(p) for p in notice.barred]
        # Deciding phrases with their places in the template.
        self.fixed: list[tuple[int, list[str]]] = []
        at = 0
        for phrase in map(words_of, notice.deciding):
            place = next(places_of(phrase, self.words, at), None) if phrase else None
            if place is None:
                raise ValueError(f"{name}: a deciding phrase isn't in the template: {' '.join(phrase)!r}")
            self.fixed.append((place, phrase))
            at = place + len(phrase)
        # A match misses at most so many words, so it holds one of any larger choice: the longest ones are rare.
        times = Counter(self.words)
        self.rare, chosen = [], 0
        for w in sorted(times, key=lambda w: (-len(w), w)):
            if chosen > len(self.words) - self.needed:
                break
            self.rare.append(w)
            chosen += times[w]

    def possible(self, lower: str) -> bool:
        if self.fixed:
            return all(w in lower for _, phrase in self.fixed for w in phrase)
        return any(w in lower for w in self.rare)

    def best(self, words: list[str]) -> tuple[float, float, int, int] | None:
        """(coverage, density, first place, place after the last) of the best match in a text."""
        result = None
        for pairs in self.around_phrases(words) if self.fixed else self.in_windows(words):
            if len(pairs) < self.needed:
                continue
            first, last = pairs[0][0], pairs[-1][0] + 1
            one = (len(pairs) / len(self.words), len(pairs) / (last - first), first, last)
            if one[1] < DENSITY or any(next(places_of(p, words, first, last), None) is not None for p in self.barred):
                continue
            if result is None or (one[:2], -one[2]) > (result[:2], -result[2]):
                result = one
        return result

    def around_phrases(self, words: list[str]) -> Iterator[list[tuple[int, int]]]:
        """Alignments with the deciding phrases as anchors, up to three for each place of the first phrase.

        Neighbouring places bound what is aligned, so a word is aligned with a template a few times at most.
        """
        (_, phrase), *others = self.fixed
        starts = list(places_of(phrase, words))
        for k, start in enumerate(starts):
            low = max(0, start - self.reach, starts[k - 1] + len(phrase) if k else 0)
            high = min(len(words), start + self.reach, starts[k + 1] if k + 1 < len(starts) else len(words))
            anchors = [start]
            end = start + len(phrase)
            for _, other in others:
                place = next(places_of(other, words, end, high), None)
                if place is None:
                    break
                anchors.append(place)
                end = place + len(other)
            if len(anchors) < len(self.fixed):
                continue
            yield self.joined(words, anchors, low, high)
            # Words that repeat in the surroundings are no anchors: once more within the template's own length.
            before, after = self.fixed[0][0], len(self.words) - self.fixed[-1][0] - len(self.fixed[-1][1])
            close = self.joined(words, anchors, max(low, start - before), min(high, end + after))
            yield close
            # Words that were put in push others out of that length.
            more = len(self.words) - len(close)
            if more:
                yield self.joined(words, anchors, max(low, start - before - more), min(high, end + after + more))

    def joined(self, words: list[str], anchors: list[int], low: int, high: int) -> list[tuple[int, int]]:
        """The phrases at their places, and the gaps before, between and after them aligned."""
        pairs, at, own = [], low, 0
        for place, (in_own, phrase) in zip(anchors, self.fixed, strict=True):
            pairs += shifted(align(words[at:place], self.words[own:in_own]), at, own)
            pairs += [(place + d, in_own + d) for d in range(len(phrase))]
            at, own = place + len(phrase), in_own + len(phrase)
        return pairs + shifted(align(words[at:high], self.words[own:]), at, own)

    def in_windows(self, words: list[str]) -> Iterator[list[tuple[int, int]]]:
        """Alignments with the windows of a text that share most words with the template."""
        for start, end in self.regions(words):
            for length in sorted({min(len(self.words), end - start), min(self.reach, end - start)}):
                for at in self.windows(words[start:end], length):
                    pairs = self.aligned(words, start + at, start + at + length)
                    yield pairs
                    # Words that were put in push others out of the window.
                    more = len(self.words) - len(pairs)
                    if more:
                        yield self.aligned(words, max(0, start + at - more), start + at + length + more)

    def aligned(self, words: list[str], low: int, high: int) -> list[tuple[int, int]]:
        return shifted(align(words[low:high], self.words), low, 0)

    def regions(self, words: list[str]) -> list[tuple[int, int]]:
        """Stretches of the text around the rare words, merged; no match with the density asked for reaches beyond."""
        found: list[tuple[int, int]] = []
        rare = set(self.rare)
        for i, w in enumerate(words):
            if w in rare:
                low, high = max(0, i - self.reach), min(len(words), i + self.reach + 1)
                if found and low <= found[-1][1]:
                    found[-1] = (found[-1][0], high)
                else:
                    found.append((low, high))
        return found

    def windows(self, words: list[str], length: int) -> list[int]:
        """Starts of the windows with enough shared words; of those that begin within one length, the first that shares most.

        The shared words are counted while the window slides, so the time is linear in the words.
        """
        room, shared = Counter(self.words), 0
        found: list[tuple[int, int]] = []
        for i, w in enumerate(words):
            if w in room:
                shared += room[w] > 0
                room[w] -= 1
            if i >= length and words[i - length] in room:
                room[words[i - length]] += 1
                shared -= room[words[i - length]] > 0
            at = i - length + 1
            if at >= 0 and shared >= self.needed:
                if found and at < found[-1][1] + length:
                    if shared > found[-1][0]:
                        found[-1] = (shared, at)
                else:
                    found.append((shared, at))
        return [at for _, at in found]


def shifted(pairs: list[tuple[int, int]], by_a: int, by_b: int) -> list[tuple[int, int]]:
    return [(i + by_a, j + by_b) for i, j in pairs]


def scan(
    docs: DataFrame, templates: dict[str, Notice | str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document and template found in it: id, license, coverage, density, start_word, end_word.

    Words are runs of letters and digits in lower case, dots and hyphens within them included; start_word and end_word bound
    the best match (of equal ones the first) among the words of the whole text. A template given as a plain text has no deciding
    phrases; a phrase that isn't in its template is an error. Null and empty texts hold no license, templates without
    words are never found. Repeated rows give a row each; other columns aren't read. An empty table gives no rows.
    """
    notices = {n: Notice(t) if isinstance(t, str) else t for n, t in sorted(templates.items())}
    for name, notice in notices.items():
        Template(name, notice, coverage)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t for t in (Template(n, x, coverage) for n, x in notices.items()) if t.words]
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column("text")):
                lower, words = (text.as_py() or "").lower(), None
                for template in known:
                    if not template.possible(lower):
                        continue
                    words = WORD.findall(lower) if words is None else words
                    best = template.best(words)
                    if best is not None:
                        at.append(i)
                        rows.append((template.name, *best))
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64()))]
                + [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                names=["id", "license", "coverage", "density", "start_word", "end_word"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        find, f"id {kind}, license string, coverage double, density double, start_word bigint, end_word bigint"
    )
