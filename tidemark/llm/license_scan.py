"""Operator 6: find license notices by winnowed fingerprints of templates and banded alignment."""

from __future__ import annotations

import bisect
import re
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices of widely used public licenses, as their texts ask to be quoted.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, '
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
}

PLAIN = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in bytes(range(256)).lower())
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
MATCH = "license string, coverage double, matched int, start long, end long"


class Index:
    """Templates as word numbers and an inverted index of their winnowed fingerprints.

    A fingerprint is a run of ``run`` words; of every ``window`` neighbouring ones the smallest by hash is indexed,
    so any ``run + window - 1`` words in a row that a text shares with a template meet in the index. A template of
    fewer words than a run has none and is refused.
    """

    def __init__(self, templates: Mapping[str, str], run: int = 3, window: int = 2):
        self.run, self.numbers, self.names, self.tokens = run, {}, sorted(templates), []
        for name in self.names:
            words = templates[name].encode().translate(PLAIN).split()
            if len(words) < run:
                raise ValueError(f"template {name} has fewer than {run} words")
            self.tokens.append([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words])
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, tokens in enumerate(self.tokens):
            codes = self.codes(np.array(tokens, dtype=np.int64))
            mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
            spans = range(max(1, len(codes) - window + 1))
            for place in sorted({i + int(np.argmin(mixed[i : i + window])) for i in spans}):
                self.places[int(codes[place])].append((t, place))
        self.fingerprints = np.array(sorted(self.places), dtype=np.int64)

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        """One number for each run of words, exact; 0 for runs with a word that no template has."""
        n = len(numbers) - self.run + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        base = 1 << 63 // self.run
        out, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        for i in range(self.run):
            out = out * base + numbers[i : i + n]
            known &= numbers[i : i + n] > 0
        return np.where(known, out, 0)


def align(template: list[int], text: list[int], shift: int, band: int) -> tuple[int, int, int] | None:
    """Best alignment of a whole template with part of a text, near the diagonal ``shift``.

    Equal words score 2, others and gaps cost 1. Returns matched words and the text's span of words that the matched
    ones cover, or None without a match. A cell is (score, matched, -first, last); larger cells win, so ties go to more
    matches, then to the earlier place.
    """
    low = -(1 << 60)
    width = 2 * band + 1
    # cell k of row i stands for text position i + shift - band + k
    row = [(0, 0, low, low)] * width
    for i, word in enumerate(template):
        fresh = []
        for k in range(width):
            j = i + shift - band + k
            if 0 <= j < len(text) and text[j] == word:
                score, matched, first, last = row[k]
                cell = (score + 2, matched + 1, first if matched else -j, j)
            else:
                score, matched, first, last = row[k]
                cell = (score - 1, matched, first, last)
            if k + 1 < width:  # a template word that the text lacks
                score, matched, first, last = row[k + 1]
                cell = max(cell, (score - 1, matched, first, last))
            if k:  # a text word that the template lacks
                score, matched, first, last = fresh[k - 1]
                cell = max(cell, (score - 1, matched, first, last))
            fresh.append(cell)
        row = fresh
    score, matched, first, last = max(row)
    return (matched, -first, last + 1) if matched else None


def find(data: bytes, index: Index, least_coverage: float) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, matched words, first and last word) of the notices in a text, none overlapping a better one."""
    get = index.numbers.get
    numbers = [get(w, 0) for w in data.translate(PLAIN).split()]
    codes = index.codes(np.array(numbers, dtype=np.int64))
    hits = np.flatnonzero(np.isin(codes, index.fingerprints)) if len(codes) and codes.any() else ()
    if not len(hits):
        return []
    diagonals: dict[int, set[int]] = defaultdict(set)
    for place in hits.tolist():
        for t, at in index.places[int(codes[place])]:
            diagonals[t].add(place - at)
    found, names = [], []
    for t, shifts in diagonals.items():
        template = index.tokens[t]
        band = max(4, len(template) // 8)
        spans, done = [], None
        for shift in sorted(shifts):
            # a diagonal inside the last one's half band is aligned with it
            if done is not None and shift - done <= band // 2:
                continue
            done = shift
            low = max(0, shift - band)
            met = align(template, numbers[low : shift + len(template) + band + 1], shift - low, band)
            if met and met[0] >= least_coverage * len(template):
                spans.append((met[0], -(low + met[1]), low + met[2]))
        found += [(met[0] / len(template), met) for met in spans]
        names += [index.names[t]] * len(spans)
    return best_apart([(name, coverage, matched, -first, last) for name, (coverage, (matched, first, last)) in zip(names, found)])


def best_apart(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """Of overlapping notices the one with most matched words stays, then the better covered, earlier, first by name; in text order."""
    kept: list[tuple[str, float, int, int, int]] = []
    ends: list[tuple[int, int]] = []  # spans kept so far, in text order
    for notice in sorted(set(found), key=lambda f: (-f[2], -f[1], f[3], f[4], f[0])):
        at = bisect.bisect_left(ends, (notice[3], notice[4]))
        if (at == 0 or ends[at - 1][1] <= notice[3]) and (at == len(ends) or notice[4] <= ends[at][0]):
            ends.insert(at, (notice[3], notice[4]))
            kept.append(notice)
    return sorted(kept, key=lambda f: f[3])


def scan(text: str | None, index: Index, least_coverage: float) -> list[tuple[str, float, int, int, int]]:
    """Notices of a text with their spans in code points, [start, end)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    found = find(data, index, least_coverage)
    if not found:
        return []
    places = [m.span() for m in TOKEN.finditer(data.lower())]
    chars = lambda at: len(data[:at].decode("utf-8", "surrogatepass"))
    return [(name, coverage, matched, chars(places[first][0]), chars(places[last - 1][1])) for name, coverage, matched, first, last in found]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, least_coverage: float = 0.8) -> DataFrame:
    """One row per notice found: doc_id, license, coverage, matched, start and end.

    Whole texts are searched. ``coverage`` is the share of the template's words that the alignment matches in order,
    at least ``least_coverage``. The index of the templates, a parameter, goes to every task. Null and empty texts have
    no notices; repeated rows are searched each; other columns are ignored; a word is a run of ASCII letters, digits
    and non-ASCII characters, ASCII case aside; a null doc_id stays; no rows give no rows.
    """
    index = Index(templates)

    @F.pandas_udf(f"array<struct<{', '.join(part.replace(' ', ':') for part in MATCH.split(', '))}>>")
    def notices(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([scan(text, index, least_coverage) for text in texts], dtype=object)

    return docs.select("doc_id", F.inline(notices("text")))
