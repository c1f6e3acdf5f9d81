"""License scan by patience alignment.

Text and template are compared word by word: words that occur once in both are
candidates for anchors, the longest increasing subsequence of their places is
kept, and the gaps between anchors are aligned in the same way. The share of
template words that found a partner is the coverage.

Licenses of one family share their wording, so coverage alone cannot tell them
apart. A statement counts only if every telling word of the template (names,
"lesser", "noncommercial", version numbers) found a partner, and if no other
telling word stands between its words. Where statements overlap, the one wins
whose matched words exceed the text's own words between them by most. A tag
``SPDX-License-Identifier:`` is reported as the license it names.

A template is only aligned where it can match: if its coverage is to reach the
threshold, one of its key words (distinct words that are no stop words) must
be in the text, because there are more of them than words may be missing.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")
_BSD_THIRD = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software. ")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.")

#: Notices and texts by which a work states its license (public
#: wording).
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."],
    "MIT": [
        _MIT + _DISCLAIMER,
        _MIT + _DISCLAIMER + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "ISC": [
        _ISC,
        _ISC + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "BSD-2-Clause": [_BSD_TWO, _BSD_TWO + _BSD_DISCLAIMER],
    "BSD-3-Clause": [_BSD_TWO + _BSD_THIRD, _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/."],
    "CC0-1.0": [
        "Licensed under CC0 1.0.",
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and "
        "related or neighboring rights to this work."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it freely"],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt"],
}
# The GNU family (name, kind of license, version) ...
for _id, _kind, _version in [("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"),
                             ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")]:
    TEMPLATES[_id] = [
        f"This work is licensed under the GNU {_kind}General Public License, version {_version}.",
        *(f"This {_work} is free software: you can redistribute it and/or modify it under the terms of the GNU "
          f"{_kind}General Public License as published by the Free Software Foundation, either version {_version} of "
          "the License, or (at your option) any later version."
          for _work in (["program", "library"] if _kind == "Lesser " else ["program"]))]
# ... the Creative Commons family, in every version ...
for _short, _long in [("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-ND", "-NoDerivatives"), ("BY-NC", "-NonCommercial"),
                      ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives")]:
    for _version, _law in [("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")]:
        TEMPLATES[f"CC-{_short}-{_version}"] = [
            f"Licensed under CC {_short} {_version}.",
            f"This work is licensed under a Creative Commons Attribution{_long} {_version} {_law} License.",
            f"Creative Commons Attribution{_long} {_version} {_law}"]
# ... and licenses that are stated by their name alone.
for _id, _name in [("MIT", "MIT"), ("BSD", "BSD"), ("BSD-2-Clause", "BSD 2-Clause"), ("BSD-3-Clause", "BSD 3-Clause"),
                   ("ISC", "ISC"), ("Zlib", "zlib")]:
    TEMPLATES.setdefault(_id, []).append(f"Released under the {_name} License.")

#: Words that tell licenses of one wording apart. A statement has all of its
#: template's, and no other one inside.
TELLING = frozenset("""affero lesser library noncommercial nc sharealike sa noderivatives noderivs nd apache mit bsd isc
zlib mozilla eclipse boost cc0 clause""".split())
#: A tag that names its license itself.
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([\w.+-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[\w.+-]+)*)")

WORD = re.compile(r"\w+")
#: Words too common to say that a license may be near.
COMMON = frozenset("""a an and any are as at be by for from if in is it of on or that the this to was with you your
not no all can may must one use file work copy 0 2 3 4 v""".split())


def increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence (patience sorting)."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for i, x in enumerate(places):
        pile = bisect_left(tops, x)
        back.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(x)
            last.append(i)
        else:
            tops[pile], last[pile] = x, i
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text, template) places of a patience alignment."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a >= b or c >= d:
            continue
        ours, theirs = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(template[c:d], c) if theirs[w] == 1}
        both = [(i, at[w]) for i, w in enumerate(text[a:b], a) if w in at and ours[w] == 1]
        if not both:
            continue
        anchors = [both[i] for i in increasing([y for _, y in both])]
        found += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        todo += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges, edges[1:])]
    return sorted(found)


class Template:
    def __init__(self, license_id: str, text: str, min_coverage: float):
        self.license_id = license_id
        self.words = [w.lower() for w in WORD.findall(text)]
        self.needed = -(-len(self.words) * min_coverage // 1)
        counts = Counter(self.words)
        self.first = {w: self.words.index(w) for w in counts}
        self.telling = frozenset(w for w in counts if w in TELLING or w.isdigit())
        allowed = len(self.words) - self.needed  # words that may be missing
        keys = [w for w in self.first if w not in COMMON]
        # Always more key words than words that may be missing.
        more = [w for w in self.first if w in COMMON]
        while sum(counts[w] for w in keys) <= allowed and more:
            keys.append(more.pop())
        self.keys = frozenset(keys)


def scan(text: str, templates: list[Template], keys: frozenset[str], min_coverage: float,
         ) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, matched words, start, end in code points), one per
    statement; where statements overlap, the better one."""
    lower = text.lower()
    words = WORD.findall(lower)
    present = keys.intersection(words)
    if not present and "SPDX" not in text:
        return []
    places: dict[str, list[int]] = {w: [] for w in present}
    for i, w in enumerate(words):
        if w in places:
            places[w].append(i)
    found = []
    for t in templates:
        here = t.keys & present
        if not here:
            continue
        n = len(t.words)
        slack = n // 4 + 3
        past = -1
        for p, w in sorted((p, w) for w in here for p in places[w]):
            if p <= past:
                continue
            start = max(0, p - t.first[w] - slack, past + 1)
            window = words[start:p - t.first[w] + n + slack]
            pairs = align(window, t.words)
            if len(pairs) < t.needed or len(pairs) < min_coverage * n:
                continue
            if t.telling - {t.words[y] for _, y in pairs}:
                continue
            ours = {x for x, _ in pairs}
            begin, end = pairs[0][0], pairs[-1][0]
            strange = [window[x] for x in range(begin, end) if x not in ours]
            if not TELLING.isdisjoint(strange):
                continue
            found.append((len(pairs), len(strange), len(pairs) / n, t.license_id, start + begin, start + end))
            past = start + end
    tags = [(m[1], 1.0, len(WORD.findall(m[1])), m.start(1), m.end(1)) for m in SPDX.finditer(text)]
    if not found:
        return tags
    spans = [m.span() for m in WORD.finditer(lower)]
    if len(lower) != len(text):  # lower-casing changed lengths: take the original's words
        original = [m.span() for m in WORD.finditer(text)]
        spans = original if len(original) == len(spans) else spans
    out, taken = tags, []
    for matched, strange, coverage, name, a, b in sorted(found, key=lambda x: (x[1] - x[0], -x[2], x[3], x[4])):
        if all(b < x or a > y for x, y in taken):
            taken.append((a, b))
            out.append((name, coverage, matched, spans[a][0], spans[b][1]))
    return sorted(out, key=lambda x: (x[3], x[0]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_coverage: float = 0.8, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per license statement found: ``doc_id, license, coverage,
    matched_words, span_start, span_end`` (code points of the text).

    Whole texts are scanned, however long, and any number of statements is
    reported. Null and empty texts have none. Repeated rows report their own;
    ids may be null. An empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = templates if templates is not None else TEMPLATES

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Template(k, t, min_coverage) for k, texts in names.items() for t in texts]
        keys = frozenset().union(*(t.keys for t in ready))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                index, rows = [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    for row in scan(text or "", ready, keys, min_coverage):
                        index.append(i)
                        rows.append(row)
                cols = list(zip(*rows)) or [()] * 5
                kinds = [pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(index, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                    ["doc_id", "license", "coverage", "matched_words", "span_start", "span_end"])

    return docs.select(id_col, text_col).mapInArrow(
        work, f"doc_id {kind}, license string, coverage double, matched_words int, span_start long, span_end long")
