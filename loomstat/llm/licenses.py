"""License notices in documents, found by patience alignment with known templates.

``align`` matches two word lists in order: it keeps a common beginning and end, takes as anchors the
words that occur once in both, keeps the longest increasing run of them, and does the same between
each two anchors. The share of a template's words that find a partner is its coverage; words put in,
left out or misspelt only cost what they touch. Every text is looked through in full, but aligned only
where half of a template's telling words (no function words) occur within about its length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.llm import words as W
from loomstat.llm.spotsigs import ANCHORS
from loomstat.llm.tables import map_texts

WORD = re.compile(r"[0-9a-z]+")

# Wordings of public licenses and of the notices that refer to them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."
    ),
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def align(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Matched places of two word lists, rising in both; each match joins equal words."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, j, k, m = work.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        once_a, once_b = Counter(a[i:j]), Counter(b[k:m])
        place = {w: at for at, w in enumerate(b[k:m], k) if once_b[w] == 1}
        pairs = [(at, place[w]) for at, w in enumerate(a[i:j], i) if once_a[w] == 1 and w in place]
        anchors = _rising(pairs)
        if anchors:
            out += anchors
            edges = [(i - 1, k - 1), *anchors, (j, m)]
            work += [(x + 1, y, p + 1, q) for (x, p), (y, q) in zip(edges, edges[1:])]
    return sorted(out)


def _rising(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given by rising first places, whose second places rise too."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (_, p) in enumerate(pairs):
        pile = bisect_left(tops, p)
        back.append(at[pile - 1] if pile else -1)
        tops[pile : pile + 1], at[pile : pile + 1] = [p], [n]
    run, n = [], at[-1] if at else -1
    while n >= 0:
        run.append(pairs[n])
        n = back[n]
    return run[::-1]


@dataclass(frozen=True)
class Match:
    license: str
    coverage: float
    start: int
    end: int


class Scanner:
    """Templates prepared for looking through many texts."""

    def __init__(self, templates: Mapping[str, str] = TEMPLATES, least: float = 0.8):
        self.least = least
        self.words = {name: WORD.findall(t.lower()) for name, t in templates.items()}
        self.telling = {name: {w for w in ws if w not in ANCHORS} or set(ws) for name, ws in self.words.items()}
        self.owners: dict[str, list[str]] = {}
        for name, ws in self.telling.items():
            for w in ws:
                self.owners.setdefault(w, []).append(name)

    def scan(self, text: str) -> list[Match]:
        """Matches of the least coverage or more, by matched words; of overlapping ones the first stays."""
        spans = [(m.group(), m.start(), m.end()) for m in WORD.finditer(_ascii_lower(text))]
        spots: dict[str, list[int]] = {}
        for n, (w, _, _) in enumerate(spans):
            for name in self.owners.get(w, ()):
                spots.setdefault(name, []).append(n)
        found = []
        for name, places in spots.items():
            size, need = len(self.words[name]), -(-len(self.telling[name]) // 2)
            for first, last in _clusters(places, size):
                inside = [spans[n][0] for n in places[bisect_left(places, first) : bisect_left(places, last + 1)]]
                if len(set(inside)) < need:
                    continue
                low, high = max(0, first - size), min(len(spans), last + size + 1)
                found += self._best(name, spans, low, high)
        found.sort(key=lambda m: (-m.coverage * len(self.words[m.license]), -m.coverage, m.start, m.license))
        kept: list[Match] = []
        taken: list[tuple[int, int]] = []
        for m in found:
            at = bisect_left(taken, (m.start, m.end))
            if (not at or taken[at - 1][1] <= m.start) and (at == len(taken) or m.end <= taken[at][0]):
                taken.insert(at, (m.start, m.end))
                kept.append(m)
        return kept

    def _best(self, name: str, spans: list[tuple[str, int, int]], low: int, high: int) -> list[Match]:
        """All matches within a stretch of the text that do not overlap.

        A stretch is aligned as a whole, and again what lies left and right of a match, until no match
        is left. Notices in a row leave no word unique, so where the whole gives none, or one drawn
        out over more than 1.5 template lengths, windows of about one notice's length are aligned.
        """
        words, size = self.words[name], len(self.words[name])
        text = [w for w, _, _ in spans[low:high]]
        own = set(words)
        before = list(accumulate((w in own for w in text), initial=0))
        found: set[tuple[int, int, int]] = set()
        work = [(0, len(text))]
        while work:
            a, b = work.pop()
            if before[b] - before[a] < self.least * size:
                continue
            match = self._match(name, text, a, b)
            if b - a > 16 * size:  # halves that share more than the longest window
                middle = (a + b) // 2
                work += [(a, middle + 3 * size), (middle - 3 * size, b)]
                found |= {match} if match else set()
                continue
            new = [match] if match else []
            if not match or match[1] - match[0] > 1.5 * size:
                new = _apart([*new, *self._swept(name, text, before, a, b)], size)
            found.update(new)
            edges = [a, *(x for m in sorted(new) for x in m[:2]), b]
            work += list(zip(edges[::2], edges[1::2])) if new else []
        return [Match(name, n / size, spans[low + a][1], spans[low + b - 1][2]) for a, b, n in _apart(found, size)]

    def _match(self, name: str, text: list[str], a: int, b: int) -> tuple[int, int, int] | None:
        """First word, end and number of matched words of the alignment with ``text[a:b]``, if enough."""
        size = len(self.words[name])
        pairs = _dense(align(self.words[name], text[a:b]), size)
        return (a + pairs[0][1], a + pairs[-1][1] + 1, len(pairs)) if len(pairs) >= self.least * size else None

    def _swept(self, name: str, text: list[str], before: list[int], a: int, b: int) -> list[tuple[int, int, int]]:
        """Matches of windows, each size of them for notices of 0.88 to 1.5 times a length that grows by half."""
        size, out = len(self.words[name]), []
        for scale in (1.0, 1.5, 2.25):
            width = int(1.75 * scale * size)
            step = max(1, width // 7)
            for at in range(a, max(a, b - width) + step, step):
                to = min(at + width, b)
                if before[to] - before[min(at, to)] >= self.least * size:
                    out.append(self._match(name, text, at, to))
        return [m for m in out if m]


def _apart(found: Iterable[tuple[int, int, int]], size: int) -> list[tuple[int, int, int]]:
    """Of (first, end, matched words) those that do not overlap: the fullest and shortest first.

    One drawn out over more than 1.5 template lengths comes first only if it meets fewer than two others.
    """
    order = sorted(found, key=lambda m: (-m[2], m[1] - m[0], m))
    short = _free([m for m in order if m[1] - m[0] <= 1.5 * size])
    starts, ends = [m[0] for m in short], [m[1] for m in short]
    drawn = [m for m in order if m[1] - m[0] > 1.5 * size]
    drawn = [m for m in drawn if bisect_left(starts, m[1]) - bisect_right(ends, m[0]) < 2]
    return _free(sorted([*short, *drawn], key=lambda m: (-m[2], m[1] - m[0], m)))


def _free(order: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those that overlap none taken before, by place."""
    kept: list[tuple[int, int, int]] = []
    for m in order:
        at = bisect_left(kept, m)
        if (not at or kept[at - 1][1] <= m[0]) and (at == len(kept) or m[1] <= kept[at][0]):
            kept.insert(at, m)
    return kept


def _dense(pairs: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """The longest run of matches without a hole of more than half the template's length."""
    runs: list[list[tuple[int, int]]] = []
    for p in pairs:
        if runs and p[1] - runs[-1][-1][1] <= max(3, size // 2):
            runs[-1].append(p)
        else:
            runs.append([p])
    return max(runs, key=len, default=[])


def _clusters(places: list[int], gap: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for n in places:
        if out and n - out[-1][1] <= gap:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [(a, b) for a, b in out]


def _ascii_lower(text: str) -> str:
    """Lower case of A-Z alone, so that places stay those of the text."""
    return text.translate(_LOWER)


_LOWER = {i: i + 32 for i in range(65, 91)}


def _worth_scanning(texts: pa.Array, scanner: Scanner) -> np.ndarray:
    """Texts that hold half of some template's telling words, found on the Arrow buffer.

    A word here is what stands between bytes that are neither letters nor digits.
    """
    data, offsets = W.text_buffer(texts)
    tables = _tables(scanner)
    hit = np.zeros((len(texts), len(scanner.words)), np.int32)
    for start, end in W.pieces(data, offsets):
        part = W.LOWER[data[start:end]]
        spaced = np.where(tables.letters[part], part, np.uint8(32))
        first, last = W.spans(spaced, offsets - start, 0, len(part))
        h = W.range_hashes(spaced, first, last)
        maybe = np.flatnonzero(tables.low[(h & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(tables.hashes, h[maybe])
        real = (at < len(tables.hashes)) & (tables.hashes[np.minimum(at, len(tables.hashes) - 1)] == h[maybe])
        doc = np.searchsorted(offsets, first[maybe[real]] + start, "right") - 1
        seen = np.unique(doc.astype(np.int64) * len(tables.hashes) + at[real])
        np.add.at(hit, seen // len(tables.hashes), tables.owners[seen % len(tables.hashes)])
    return np.flatnonzero((hit >= tables.need).any(1))


@dataclass
class _Tables:
    letters: np.ndarray
    hashes: np.ndarray
    low: np.ndarray
    owners: np.ndarray
    need: np.ndarray


def _tables(scanner: Scanner) -> _Tables:
    if not hasattr(scanner, "_ready"):
        vocabulary = sorted(scanner.owners)
        hashes, _ = W.word_hashes(pa.array(vocabulary))
        order = np.argsort(hashes)
        names = list(scanner.words)
        owners = np.array([[int(n in scanner.owners[w]) for n in names] for w in vocabulary], np.int32)[order]
        letters = np.zeros(256, bool)
        letters[[*range(48, 58), *range(97, 123)]] = True
        low = np.zeros(1 << 16, bool)
        low[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
        need = np.array([-(-len(scanner.telling[n]) // 2) for n in names], np.int32)
        scanner._ready = _Tables(letters, hashes[order], low, owners, need)
    return scanner._ready


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``matches``, an array of (license, coverage, start, end), best first, for every row.

    Places are characters of the text. Null and empty texts, and texts without a notice, have an
    empty array. Rows may repeat; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast((dict(templates), least))
    kind = T.ArrayType(T.StructType([
        T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    arrow = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(texts: pa.Array) -> list:
        scanner = _scanner(*sent.value)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for i, j in W.slices(texts):
            part = texts.slice(i, j - i)
            for d in _worth_scanning(part, scanner):
                out[i + d] = [vars(m) for m in scanner.scan(part[int(d)].as_py() or "")]
        return [pa.array(out, arrow)]

    return map_texts(docs, [F.col(key)], F.col(text), [("matches", kind)], work).toDF(key, "matches")


_scanners: dict[tuple, Scanner] = {}


def _scanner(templates: dict[str, str], least: float) -> Scanner:
    name = (tuple(sorted(templates.items())), least)
    if name not in _scanners:
        _scanners.clear()
        _scanners[name] = Scanner(templates, least)
    return _scanners[name]
