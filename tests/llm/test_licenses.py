import random
import re
from itertools import combinations

from blotter.llm import queries as Q
from blotter.llm.licenses import TELLING, TEMPLATES, Template, align, increasing, scan, scan_licenses
from fixtures import awkward, frame, text, words

READY = [Template(k, t, 0.8) for k, ts in TEMPLATES.items() for t in ts]
KEYS = frozenset().union(*(t.keys for t in READY))


def found(t: str):
    return scan(t, READY, KEYS, 0.8)


def test_longest_increasing_subsequence_against_brute_force():
    r = random.Random(1)
    for _ in range(200):
        x = r.sample(range(12), r.randint(0, 9))
        best = max((n for n in range(len(x) + 1) for c in combinations(x, n) if list(c) == sorted(c)), default=0)
        got = [x[i] for i in increasing(x)]
        assert got == sorted(got) and len(got) == best


def test_alignment_is_monotone_and_equal():
    r = random.Random(2)
    for _ in range(100):
        a, b = ([r.choice("abcdefgh") for _ in range(r.randint(0, 15))] for _ in range(2))
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert len(align("a b c d e".split(), "a b x d e".split())) == 4


def test_every_template_is_found_whole_and_changed():
    r = random.Random(3)
    for name, ts in TEMPLATES.items():
        for t in ts:
            got = found(f"{text(50, 1)} {t.upper()} {text(40, 2)}")
            assert [(g[0], g[1]) for g in got] == [(name, 1.0)], (name, got)
            w = t.split()
            if len(w) > 30:  # a tenth of the words replaced
                # Words and numbers stay that tell licenses of one wording apart.
                plain = [i for i, x in enumerate(w) if not re.search(r"\d", x)
                         and TELLING.isdisjoint(re.findall(r"\w+", x.lower()))]
                for i in r.sample(plain, len(w) // 10):
                    w[i] = "zzz"
                got = found(text(50, 1) + "\n" + "\n".join(w))
                assert [g[0] for g in got] == [name] and 0.8 <= got[0][1] < 1


def test_spans_and_several_statements():
    a, b = "Released under the MIT License.", "Licensed under CC BY-NC 4.0."
    t = f"é {a} {a} x {b}\n{text(30, 1)} {a}"
    got = found(t)
    assert [(g[0], t[g[3]:g[4]]) for g in got] == [("MIT", a[:-1]), ("MIT", a[:-1]), ("CC-BY-NC-4.0", b[:-1]), ("MIT", a[:-1])]


def test_key_words_cannot_miss_a_match():
    for t in READY:
        missing = len(t.words) - t.needed
        assert sum(t.words.count(w) for w in t.keys) > missing


def test_licenses_of_one_family_are_told_apart():
    for notice, name in [
            ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
            ("Creative Commons Attribution-NonCommercial 4.0 International", "CC-BY-NC-4.0"), ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0"),
            ("Licensed under CC BY 3.0", "CC-BY-3.0"), ("Released under the BSD License.", "BSD"),
            ("Released under the BSD 3-Clause License.", "BSD-3-Clause"), ("Released under the X11 License.", None),
            ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 3 of the License, or "
             "(at your option) any later version.", "LGPL-3.0"),
            ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version.", "AGPL-3.0"),
            ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
            ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("# SPDX-License-Identifier: MIT OR Apache-2.0\nx", "MIT OR Apache-2.0")]:
        got = [g[0] for g in found(f"{text(20, 1)}\n{notice}\n{text(20, 2)}")]
        assert got == ([name] if name else []), (notice, got)


def test_bsd_texts_by_their_clauses():
    two, three = TEMPLATES["BSD-2-Clause"][1], TEMPLATES["BSD-3-Clause"][1]
    assert [g[0] for g in found(two)] == ["BSD-2-Clause"] and [g[0] for g in found(three)] == ["BSD-3-Clause"]


def test_plain_texts_have_none():
    assert found(text(3000, 5)) == []
    assert found("The license of the driver was under the seat of this version of the car, by the public road.") == []


def test_awkward_rows(spark):
    notice = "This work is licensed under the GNU General Public License, version 3."
    rows = awkward() + [(20, notice, "", ""), (20, notice, "", ""), (None, notice, None, None),
                        (21, text(60_000, 9) + " " + notice, "", "")]
    got = scan_licenses(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.license) for r in got), key=str) == sorted(
        [(20, "GPL-3.0")] * 2 + [(None, "GPL-3.0"), (21, "GPL-3.0")], key=str)


def test_empty_table(spark):
    assert scan_licenses(frame(spark, []).limit(0)).collect() == []


def test_query_against_plain_search(spark, sf_small):
    notices = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
               "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
               "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    want = sorted((d.doc_id, k) for d in spark.read.parquet(f"{sf_small}/documents.parquet").collect()
                  for k, n in notices.items() for _ in re.findall(re.escape(n), d.text or "", re.I))
    assert sorted((r.doc_id, r.license) for r in Q.op6_license_scan(spark, sf_small).collect()) == want
