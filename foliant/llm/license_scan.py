"""Operator 6: license scans by patience alignment.

A text is searched for each template where it holds one of the template's telling words: the
rarest words that together are over 1 - ``least`` of it, so any text that covers ``least`` of
the template holds one. The stretch around such words is aligned with the template: words
that occur once in both are anchors, the longest increasing run of anchors is kept, and the
gaps between them are aligned in the same way (equal ends first). A stretch where a telling
word recurs may hold several copies, whose words are no anchors: its parts between recurrences
and the template's place around each telling word, close and with a quarter more on both
sides, are aligned too. Coverage is the share of the template's words that found a partner,
the best of these alignments.

Defined results: null, empty and other texts without a license have a null license, coverage
0 and no span. Of equally covered templates the longer, then the first by name wins. Repeated
rows and null ids are rows of their own. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices of public licenses.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT-notice": "Released under the MIT License.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "all-rights-reserved": "All rights reserved.",
}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        tops[p : p + 1] = [v]
        last[p : p + 1] = [i]
        back.append(last[p - 1] if p else -1)
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of partners of a and b, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        na, nb = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if nb[w] == 1}
        unique = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if na[w] == 1 and w in place]
        anchors = [unique[i] for i in _increasing([j for _, j in unique])]
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False) if i + 1 < k and j + 1 < m]
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        self._least = least
        self._templates = []
        for name, text in templates.items():
            words = words_of(text.encode())
            count = Counter(words)
            telling: set[bytes] = set()
            held = 0
            for w in sorted(count, key=lambda w: (-len(w), w)):
                if held > (1 - least) * len(words):
                    break
                telling.add(w)
                held += count[w]
            places = {w: [q for q, x in enumerate(words) if x == w] for w in telling}
            self._templates.append((name, words, count, places))
        self._any = frozenset().union(*(p for _, _, _, p in self._templates))

    @staticmethod
    def _windows(words: list[bytes], at: list[int], reach: int, count: Counter[bytes], places: dict[bytes, list[int]]) -> Iterator[tuple[int, int]]:
        """The stretch around the telling words ``at`` and, where one recurs, its likely copies."""
        yield max(0, at[0] - reach), min(len(words), at[-1] + reach + 1)
        seen: Counter[bytes] = Counter()
        cuts = [0]
        for k, i in enumerate(at):
            if seen[words[i]] == count[words[i]]:
                cuts.append(k)
                seen.clear()
            seen[words[i]] += 1
        if len(cuts) == 1:
            return
        for k, m in zip(cuts, [*cuts[1:], len(at)], strict=True):
            yield max(0, at[k] - reach, at[k - 1] + 1 if k else 0), min(len(words), at[m - 1] + reach + 1, at[m] if m < len(at) else len(words))
        for slack in (0, reach // 4 + 1):
            for s in sorted({i - q for i in at for q in places[words[i]]}):
                yield max(0, s - slack), min(len(words), s + reach + slack)

    def __call__(self, text: bytes | None) -> tuple[str | None, float, int, int]:
        """(name, coverage, first word, word after the last) of the best covered template."""
        best = (0.0, 0, "", 0, 0)
        words = words_of(text) if text else []
        if self._any.isdisjoint(words):
            return None, 0.0, 0, 0
        for name, template, count, places in self._templates:
            at = [i for i, w in enumerate(words) if w in places]
            reach, i = len(template), 0
            while i < len(at):
                j = i
                while j + 1 < len(at) and at[j + 1] - at[j] <= reach:
                    j += 1
                for a, b in self._windows(words, at[i : j + 1], reach, count, places):
                    most = sum((count & Counter(words[a:b])).values()) / reach
                    if most < self._least or (most, reach) <= best[:2]:
                        continue  # no alignment finds more partners
                    pairs = align(words[a:b], template)
                    found = (len(pairs) / reach, reach, name)
                    if pairs and (found[0], found[1]) > best[:2]:
                        best = (*found, a + pairs[0][0], a + pairs[-1][0] + 1)
                i = j + 1
        if best[0] < self._least:
            return None, 0.0, 0, 0
        return best[2], best[0], best[3], best[4]


def _scan(templates: dict[str, str], least: float, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in batches:
            for at in range(0, len(batch), 512):
                found = [scanner(t) for t in batch.column(1).slice(at, 512).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512).cast(pa.int64()), *(pa.array([f[j] for f in found], schema.field(j + 1).type) for j in range(4))], schema=schema)

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """doc_id, license, coverage and the words (from, to) that the alignment spans."""
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(_scan(templates, least, schema), "doc_id long, license string, coverage double, start long, end long")
