"""License scan by patience alignment.

Where enough words of a template stand close together in a text (counted over
the whole text), the stretch is aligned with the template: words that occur
once in both are anchors, the longest increasing subsequence of their
positions is kept, and the gaps between neighbouring anchors are aligned the
same way, down to gaps without such words, of which equal beginnings and ends
match, and in an occurrence a longest common subsequence.  Coverage is the share of the template's words that are matched.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lapmart.llm.common import WordHasher, letter_digit_words, prepare, row_of_word

COVERAGE = 0.8
# An occurrence is at most so many times as long as its template; the closer one is looked for first.
REACHES = (1.25, 2.0)
# A template of fewer words is a line of its own, of which only the first holds.
SHORT = 20

# Public license notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit-notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "agpl-3.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your "
        "option) any later version."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."),
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version."),
    "lgpl-3.0-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your "
        "option) any later version."),
    "cc-by-4.0-header": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-header": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0-header": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4.0-header": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-4.0-header": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4.0-header": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
}
_MIT_END = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE.")
_ISC_END = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE.")


def all_templates() -> dict[str, str]:
    """``TEMPLATES`` and the full texts of licenses (some 150 kB, read by the driver)."""
    files = sorted((Path(__file__).parent / "licenses").glob("*.txt"))
    return TEMPLATES | {f"{f.stem}-text": f.read_text("utf-8") for f in files} | {
        "isc-text": TEMPLATES["isc"] + _ISC_END, "mit-text": TEMPLATES["mit"] + _MIT_END}


def _increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence (patience sorting)."""
    tops, top_at, before = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile:
            before[i] = top_at[pile - 1]
        if pile == len(tops):
            tops.append(v)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = v, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: list, template: list, repeats: bool = False) -> list[tuple[int, int]]:
    """Matched (place in text, place in template), increasing in both.

    ``repeats``: gaps in which all words repeat are aligned by a longest common subsequence.
    """
    out = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(text[a:b], a) if in_text[w] == 1}
        anchors = [(place[w], j) for j, w in enumerate(template[c:d], c) if in_template[w] == 1 and w in place]
        if not anchors:
            if not repeats:
                continue
            places: dict = {}
            for j in range(d - 1, c - 1, -1):
                places.setdefault(template[j], []).append(j)
            same = [(x, j) for x in range(a, b) for j in places.get(text[x], ())]
            out += [same[i] for i in _increasing([j for _, j in same])]
            continue
        kept = [anchors[i] for i in _increasing([x for x, _ in anchors])]
        edges = [(a - 1, c - 1), *kept, (b, d)]
        out += kept
        work += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:])]
    return sorted(out)


def dense(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The consecutive matches that add up to most, each counting one and each word between them minus a quarter.

    A stray word of the template far before or behind an occurrence so is no part of it.
    """
    best, total, first, cut = 0.0, 0.0, 0, (0, 0)
    for i, (x, _) in enumerate(pairs):
        between = (x - pairs[i - 1][0] - 1) / 4 if i else 0.0
        if total - between <= 0:
            total, first = 0.0, i
        else:
            total -= between
        total += 1
        if total > best:
            best, cut = total, (first, i + 1)
    return pairs[cut[0]:cut[1]]


def tight(text: list, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same matched words in the shortest stretch that ends first."""
    out, last = [], pairs[0][0] - 1 if pairs else 0
    for x, j in pairs:
        last = next(i for i in range(last + 1, x + 1) if text[i] == text[x])
        out.append((last, j))
    after = last + 1
    for n in range(len(out) - 1, -1, -1):
        x, j = out[n]
        after = next(i for i in range(after - 1, x - 1, -1) if text[i] == text[x])
        out[n] = after, j
    return out


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.hasher = WordHasher(letter_digit_words())
        self.names = list(templates)
        self.words = []
        for t in templates.values():
            h = [x for _, _, x, _ in self.hasher.batch(pa.array([t]))]
            self.words.append(np.concatenate(h).view(np.int64))
        self.vocabulary = np.unique(np.concatenate(self.words)) if self.words else np.empty(0, np.int64)
        self.member = np.array([np.isin(self.vocabulary, w) for w in self.words])
        self.amount = [np.bincount(np.searchsorted(self.vocabulary, w), minlength=len(self.vocabulary))
                       for w in self.words]

    def batch(self, texts: pa.Array):
        """Yields (first row, words of each row, found): found has (row, template, coverage, first, last word)."""
        for lo, hi, h, counts in self.hasher.batch(texts):
            h = h.view(np.int64)
            rows, begin = row_of_word(counts), np.cumsum(counts) - counts
            at = np.minimum(np.searchsorted(self.vocabulary, h), max(0, len(self.vocabulary) - 1))
            hit = np.flatnonzero(self.vocabulary[at] == h) if len(self.vocabulary) else h[:0]
            found = []
            for t, words in enumerate(self.words):
                need = int(np.ceil(COVERAGE * len(words)))
                long = counts >= need
                if not len(words) or not long.any():
                    continue
                near = hit if long.all() else hit[long[rows[hit]]]
                place = near[self.member[t][at[near]]]
                if len(place) < need:
                    continue
                reaches = [int(np.ceil(len(words) * x)) + 1 for x in REACHES[:1 if len(words) < SHORT else None]]
                span = reaches[-1]
                # places further apart than a stretch where the row changes
                key = place + rows[place] * span
                starts = place[:len(key) - need + 1][key[need - 1:] - key[:len(key) - need + 1] < span]
                done = -1
                for s in starts.tolist():
                    if s < done:
                        continue
                    r = int(rows[s])
                    to = min(s + span, begin[r] + counts[r])
                    stretch = h[s:to]
                    # words in common, however ordered: a step of one word adds one at most
                    common = np.bincount(at[s:to][self.vocabulary[at[s:to]] == stretch], minlength=len(self.vocabulary))
                    common = int(np.minimum(common, self.amount[t]).sum())
                    if common < need:
                        done = s + need - common
                        continue
                    pairs = self._occurrence(h, s, int(begin[r] + counts[r]), words.tolist(), reaches)
                    if len(pairs) >= COVERAGE * len(words):
                        first, last = pairs[0][0], pairs[-1][0]
                        found.append((r, t, len(pairs) / len(words), first - int(begin[r]), last - int(begin[r])))
                        done = last + 1
            yield lo, counts, found

    @staticmethod
    def _occurrence(h: np.ndarray, start: int, end: int, words: list, reaches: list[int]) -> list[tuple[int, int]]:
        """Matches of the template that begins at ``start``, or too few; places in ``h``."""
        need = COVERAGE * len(words)
        best: list = []
        for reach in reaches:
            best = align(h[start:min(start + reach, end)].tolist(), words)
            if len(best) >= need:
                break
        if len(best) < need:
            return []
        # the stretch may have begun before the occurrence and ended in it
        first = start + best[0][0]
        best = [(start + x, j) for x, j in best]
        again = dense(best)
        if len(again) >= need:
            first, best = again[0][0], again
        for reach in reaches:
            stretch = h[first:min(first + reach, end)].tolist()
            pairs = dense([(first + x, j) for x, j in tight(stretch, align(stretch, words, repeats=True))])
            if len(pairs) > len(best):
                best = pairs
        return best


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """License notices in ``docs(doc_id, text)``, one row per row.

    Returns doc_id, n_words, licenses (names, sorted, comma-joined), license
    (the one with the most matched words; ties by coverage, then name), coverage (of that
    one), and spans: name:first:last:percent of each occurrence by first word
    and name.  Whole texts are scanned and each occurrence is reported.  Null
    and empty texts have none; null doc_ids and repeated rows are scanned
    like any other; other columns are ignored; an empty table gives no rows.
    """
    templates = all_templates() if templates is None else templates  # a fixed, small set
    prepare(docs.sparkSession)

    def search(batches):
        scanner = Scanner(templates)
        for batch in batches:
            n_words, names, best, coverage, spans = [], [], [], [], []
            for _, counts, found in scanner.batch(batch.column("text")):
                by_row: dict[int, list] = {}
                for r, *x in found:
                    by_row.setdefault(r, []).append(x)
                for r in range(len(counts)):
                    n_words.append(int(counts[r]))
                    hits = sorted(by_row.get(r, ()), key=lambda x: (x[2], scanner.names[x[0]]))
                    names.append(",".join(sorted({scanner.names[t] for t, *_ in hits})))
                    top = min(hits, key=lambda x: (
                        -round(x[1] * len(scanner.words[x[0]])), -x[1], scanner.names[x[0]]), default=None)
                    best.append(top and scanner.names[top[0]])
                    coverage.append(top and top[1])
                    spans.append(",".join(f"{scanner.names[t]}:{a}:{b}:{100 * c:.0f}" for t, c, a, b in hits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(names, pa.string()),
                 pa.array(best, pa.string()), pa.array(coverage, pa.float64()), pa.array(spans, pa.string())],
                ["doc_id", "n_words", "licenses", "license", "coverage", "spans"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        search, f"doc_id {kind}, n_words long, licenses string, license string, coverage double, spans string")
