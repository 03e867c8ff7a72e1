"""License scans by patience alignment of texts with license templates.

Words that occur once in the text and once in the template are anchors; the longest increasing
subsequence of their places is kept, and the gaps between anchors are aligned in the same way.  A gap
without anchors is aligned by its longest common subsequence.  The share of a template's words that
are matched is its coverage.

A text is first cut into regions: words of the template that stand close together.  A region that
lacks too many of the template's words to reach the coverage is not aligned; that is exact, because a
word that is missing cannot be matched.  A notice is a window of a region whose alignment reaches from
the window's first word to its last.  What stands around a notice changes which words are unique, so
a region is not aligned as a whole: for every window the longest common subsequence bounds what the
alignment can match, and the windows are aligned by falling bound until no better one can follow.  So
a notice is found wherever it stands in a text, and the result is that of aligning every window.

Defined results: a null or empty text has no license; of several the one with the highest coverage is
reported, then the longest, then by name, then the first in the text (the earliest end, then the
tightest); a null id is kept; rows that
repeat are scanned each; an empty table gives an empty result; other columns are not read.
"""

import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

COVERAGE = 0.8   # least share of a template's words
NEAR = 12        # words of a region are at most so far apart
TIGHT = 0.5      # least share of matched words between the first and the last of them

# Public license notices.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under
        the License.""",
    "MIT notice": "Released under the MIT License",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
}

WORD = re.compile(r"[^\W_]+")


def patience(text: list, template: list) -> list:
    """Matched places (in the text, in the template), increasing in both."""
    out, open_ = [], [(0, len(text), 0, len(template))]
    while open_:
        a, b, c, d = open_.pop()
        if a >= b or c >= d:
            continue
        once_text = {w for w, n in Counter(text[a:b]).items() if n == 1}
        once = {w for w, n in Counter(template[c:d]).items() if n == 1} & once_text
        if once:
            place = {template[j]: j for j in range(c, d) if template[j] in once}
            anchors = increasing([(i, place[text[i]]) for i in range(a, b) if text[i] in once])
            out += anchors
            left = [(a - 1, c - 1), *anchors]
            right = [*anchors, (b, d)]
            open_ += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(left, right)]
        else:
            out += common([(i, text[i]) for i in range(a, b)], template, c, d)
    return sorted(out)


def increasing(pairs: list) -> list:
    """Longest subsequence that increases in both places; pairs come in order of the first."""
    tails, piles, back = [], [], []
    for number, (_, j) in enumerate(pairs):
        pile = bisect_left(tails, j)
        back.append(piles[pile - 1] if pile else None)
        if pile == len(tails):
            tails.append(j)
            piles.append(number)
        else:
            tails[pile], piles[pile] = j, number
    out, number = [], piles[-1] if piles else None
    while number is not None:
        out.append(pairs[number])
        number = back[number]
    return out[::-1]


def common(words: list, template: list, c: int, d: int) -> list:
    """Longest common subsequence, from the places of all matches."""
    places = defaultdict(list)
    for j in range(d - 1, c - 1, -1):
        places[template[j]].append(j)
    return increasing([(i, j) for i, w in words for j in places.get(w, ())])


class Scanner:
    def __init__(self, templates: dict, coverage: float):
        self.templates = {name: WORD.findall(text.lower()) for name, text in sorted(templates.items())}
        self.counts = {name: Counter(words) for name, words in self.templates.items()}
        self.vocabulary = {w for words in self.templates.values() for w in words}
        self.coverage = coverage

    def regions(self, words: list, name: str):
        """Spans of the text where the template's words stand close together and are enough."""
        counts, need = self.counts[name], self.coverage * len(self.templates[name])
        held = [i for i, w in enumerate(words) if w in counts]
        start = 0
        for k in range(1, len(held) + 1):
            if k == len(held) or held[k] - held[k - 1] > NEAR:
                first, last = held[start], held[k - 1] + 1
                inner = Counter(words[i] for i in held[start:k])
                if sum(min(n, counts[w]) for w, n in inner.items()) >= need:
                    yield first, last
                start = k

    def dense(self, words: list, first: int, last: int, name: str):
        """Places of the template's words, in stretches outside of which no window holds enough of them."""
        counts, size = self.counts[name], len(self.templates[name])
        held = [i for i in range(first, last) if words[i] in counts]
        inner, total, end, stretch = Counter(), 0, 0, []
        for k, i in enumerate(held):
            while end < len(held) and (held[end] - i + 1) * TIGHT <= size:
                w = words[held[end]]
                inner[w] += 1
                total += inner[w] <= counts[w]
                end += 1
            if total >= self.coverage * size:
                if stretch and k > stretch[1]:
                    yield held[slice(*stretch)]
                    stretch = []
                stretch = [stretch[0] if stretch else k, end]
            total -= inner[words[i]] <= counts[words[i]]
            inner[words[i]] -= 1
        if stretch:
            yield held[slice(*stretch)]

    def notice(self, words: list, first: int, last: int, name: str):
        """(matched words, first and last place) of the region's best window, or None."""
        template, best = self.templates[name], (0,)
        least = next(k for k in range(1, len(template) + 2) if k / len(template) >= self.coverage)
        for held in self.dense(words, first, last, name):
            inner = [words[i] for i in held]
            rows = defaultdict(list)   # bound -> (last place, starts from, to)
            for e, starts in enumerate(bounds(inner, template)):
                k = max(least, best[0])
                while k <= len(template) and starts[k] >= 0:
                    after = starts[k + 1] if k < len(template) else -1
                    if after < starts[k]:
                        rows[k].append((e, int(after) + 1, int(starts[k])))
                    k += 1
            for bound in sorted(rows, reverse=True):
                if bound < best[0]:
                    break
                for e, low, high in rows[bound]:
                    if best[0] >= bound and held[e] > best[1]:
                        break
                    for s in range(high, low - 1, -1):
                        if TIGHT * (held[e] - held[s] + 1) > bound:
                            break
                        pairs = patience(inner[s:e + 1], template)
                        n = len(pairs)
                        if (n < max(least, best[0]) or TIGHT * (held[e] - held[s] + 1) > n
                                or pairs[0][0] or pairs[-1][0] != e - s or not self.near(held, s, pairs)):
                            continue
                        if n > best[0] or (held[e], -held[s]) < (best[1], -best[2]):
                            best = n, held[e], held[s]
                        if n == bound:
                            break
        return (best[0], best[2], best[1]) if best[0] else None

    @staticmethod
    def near(held, s, pairs):
        """Whether the matches at both ends stand close to the rest."""
        places = [held[s + i] for i, _ in pairs]
        return len(places) < 2 or max(places[1] - places[0], places[-1] - places[-2]) <= NEAR

    def scan(self, text: str):
        """(name, coverage, matched words, first and last character) of the best license, or None."""
        lower = text.lower()
        words = WORD.findall(lower)
        present = self.vocabulary.intersection(words)
        best, found = None, set()
        for name, template in self.templates.items():
            counts = self.counts[name]
            if sum(counts[w] for w in present if w in counts) < self.coverage * len(template):
                continue
            for first, last in self.regions(words, name):
                hit = self.notice(words, first, last, name)
                if hit is None:
                    continue
                matched, low, high = hit
                found.add(name)
                key = (-matched / len(template), -matched, name, high, -low)
                if best is None or key < best[0]:
                    best = key, (name, matched / len(template), matched, low, high)
        if best is None:
            return None
        name, share, matched, first, last = best[1]
        spans = [m.span() for i, m in enumerate(WORD.finditer(lower)) if first <= i <= last]
        return name, share, matched, spans[0][0], spans[-1][1], sorted(found)


def bounds(words: list, template: list):
    """For every place in ``words``: the latest starts of windows ending there, by common words.

    A window has a common subsequence of k words if it starts at the k-th start or before.
    """
    places = defaultdict(list)
    for j in range(len(template) - 1, -1, -1):
        places[template[j]].append(j)
    starts = np.full((len(template) + 1, len(template) + 1), -1, np.int32)
    for i, w in enumerate(words):
        starts[:, 0] = i
        for j in places[w]:
            np.maximum(starts[j + 1:, 1:], starts[j, :-1], out=starts[j + 1:, 1:])
        yield starts[-1]


def _scan(templates, coverage):
    def run(batches):
        scanner = Scanner(templates, coverage)
        for batch in batches:
            found = [scanner.scan(t) if t else None for t in batch.column(1).to_pylist()]
            none = (None, 0.0, 0, None, None, [])
            columns = list(zip(*[f or none for f in found])) or [[]] * 6
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "license", "coverage", "matched_words", "first_char", "end_char", "licenses"])
    return run


def scan(docs: DataFrame, templates=None, coverage=COVERAGE, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: license (null: none), coverage, matched_words, first_char, end_char, licenses."""
    ship(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _scan(templates or TEMPLATES, coverage),
        f"doc_id {kind}, license string, coverage double, matched_words long, first_char long, end_char long, "
        "licenses array<string>")
