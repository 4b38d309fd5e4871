"""License scans by patience alignment.

A template is aligned with a stretch of a text: words that occur once in each anchor the
alignment, the longest increasing subsequence of their places is kept, and the gaps between
anchors are aligned the same way; a gap without such words matches its common head and
tail.  The share of the template's words that align is its coverage.

A notice is a stretch of at most ``SPREAD`` times the template's words in which its coverage
reaches the least one.  Such a stretch holds that many of the template's words, counted with
repeats, so a window slides over those of a text's words that the template has and is
aligned wherever it holds enough of them, first the shortest such window, then the widest;
a window that aligns grows as long as the alignment does.  No word has to be there in particular.

Defined results: words are runs of letters and digits in lower case; null, empty and
unlicensed texts have no findings; of templates over one stretch the one with the most
aligned words counts, then the first by name; repeated notices are found each, one that
begins within another of its license is none; whole texts
of any length are scanned; rows are independent; extra columns stay.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import ship, text_of

ship(__name__)

LEAST_COVERAGE = 0.8
#: A notice's stretch holds at most this times its template's words, foreign ones in between included.
SPREAD = 2.0

#: Public license texts and notices; callers may give others.
TEMPLATES = {
    "agpl-3-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General
        Public License for more details.""",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
        OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
        THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
        (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
        more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS.""",
    "lgpl-2.1-header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
        option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General
        Public License for more details.""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    "mit-notice": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, sorted by the first place, whose second places increase."""
    tops: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        if pile == len(tops):
            tops.append(j)
            last.append(k)
        else:
            tops[pile], last[pile] = j, k
        before[k] = last[pile - 1] if pile else -1
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of equal words of a and b, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        at_b = {b[k]: k for k in range(j, j_end)}
        anchors = increasing([(k, at_b[a[k]]) for k in range(i, i_end) if in_a[a[k]] == 1 and in_b[a[k]] == 1])
        if anchors:
            out += anchors
            edges = [(i - 1, j - 1), *anchors, (i_end, j_end)]
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Templates:
    def __init__(self, templates: dict[str, str], least: float = LEAST_COVERAGE):
        self.words = {name: ws for name, text in sorted(templates.items()) if (ws := words_of(text))}
        self.counts = {name: Counter(ws) for name, ws in self.words.items()}
        self.need = {name: max(1, math.ceil(least * len(ws) - 1e-9)) for name, ws in self.words.items()}
        spread = Counter(w for ws in self.counts.values() for w in ws)
        # a notice lacks fewer of a template's words than the least coverage leaves: of any words that
        # make more than that number, one is there; words seldom found elsewhere are taken
        common = frozenset("a all an and any at be by can for form free if in is it not of on or the this to under use with you".split())
        self.keys: dict[str, frozenset[str]] = {}
        for name, counts in self.counts.items():
            missing, keys = len(self.words[name]) - self.need[name], set()
            for w in sorted(counts, key=lambda w: (w in common, counts[w], spread[w], -len(w), w)):
                if missing < 0:
                    break
                keys.add(w)
                missing -= counts[w]
            self.keys[name] = frozenset(keys)


def _grown(template: list[str], words: list[str], low: int, high: int, least: int, most: int,
           pairs: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]]]:
    """The start of a window and its alignment, after growing to either side, not below
    ``least``, to ``most`` words at most, as long as more words align."""
    for side in (1, 0):
        while len(pairs) < len(template):
            step = len(template) - len(pairs) + 1
            wider = (low, min(len(words), low + most, high + step)) if side else (max(least, high - most, low - step), high)
            more = align(template, words[wider[0]:wider[1]]) if wider != (low, high) else []
            if len(more) <= len(pairs):
                break
            (low, high), pairs = wider, more
    return low, pairs


def notices(words: list[str], name: str, templates: Templates) -> Iterator[tuple[int, int, int]]:
    """(start, end, aligned words) of one template's notices in a text's words, in order."""
    template, counts, need = templates.words[name], templates.counts[name], templates.need[name]
    most = max(int(SPREAD * len(template)), 1)
    at = [k for k, w in enumerate(words) if w in counts]
    held: Counter = Counter()
    enough = first = floor = 0  # template words in the window, its first place in ``at``, the last notice's end
    last = 0
    while last < len(at):
        right = at[last]
        word = words[right]
        held[word] += 1
        enough += held[word] <= counts[word]
        last += 1
        while at[first] <= right - most:
            w = words[at[first]]
            enough -= held[w] <= counts[w]
            held[w] -= 1
            first += 1
        if enough < need:
            continue
        short, spare, own = first, enough, held.copy()
        while True:  # the shortest window that ends here and holds enough
            w = words[at[short]]
            less = own[w] <= counts[w]
            if spare - less < need:
                break
            spare -= less
            own[w] -= 1
            short += 1
        for low in dict.fromkeys((at[short], at[first])):
            pairs = align(template, words[low:right + 1])
            if len(pairs) >= need:
                low, pairs = _grown(template, words, low, right + 1, floor, most, pairs)
                start, floor = low + pairs[0][1], low + pairs[-1][1] + 1
                yield start, floor, len(pairs)
                held, enough = Counter(), 0
                first = last = bisect_left(at, floor)
                break


def scan_text(text: str, templates: Templates) -> list[tuple[str, float, int, int]]:
    """(license, coverage, start, end) of the notices in one text, in order; code points."""
    places = [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
    words = [p[0] for p in places]
    kinds = set(words)
    found = []
    for name, counts in templates.counts.items():
        if kinds.isdisjoint(templates.keys[name]) or sum(n for w, n in counts.items() if w in kinds) < templates.need[name]:
            continue
        size = len(templates.words[name])
        found += [(-aligned, name, aligned / size, low, high) for low, high, aligned in notices(words, name, templates)]
    taken: list[tuple[int, int]] = []
    out = []
    for _, name, coverage, low, high in sorted(found):
        if all(high <= a or b <= low for a, b in taken):
            taken.append((low, high))
            out.append((name, coverage, places[low][1], places[high - 1][2]))
    return sorted(out, key=lambda x: x[2])


FOUND = "array<struct<license:string,coverage:double,start:long,end:long>>"


def scanned(docs: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None,
            least: float = LEAST_COVERAGE) -> DataFrame:
    """``docs`` with ``license_spans``."""
    given = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Templates(given, least)
        for texts in batches:
            yield pd.Series([[{"license": n, "coverage": c, "start": a, "end": b} for n, c, a, b in scan_text(t, known)]
                             for t in texts], dtype=object)

    return docs.withColumn("license_spans", F.pandas_udf(run, FOUND)(text_of(text_col)))
