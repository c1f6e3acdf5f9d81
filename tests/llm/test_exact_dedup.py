import hashlib
import re
import sys
from collections import defaultdict

import pytest

from blotter.llm import queries as Q
from blotter.llm.exact_dedup import exact_dedup
from fixtures import awkward, frame, text

sys.path.insert(0, "tests")


def expected(rows):
    groups = defaultdict(list)
    for at, (i, t, *_) in enumerate(rows):
        t = t or ""
        norm = re.sub(r"[\x20\x09-\x0D]", "", t)
        groups[norm].append((-len(t), i is None, i or 0, at))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for n, none, i, at in members:
            out.append((None if none else i, None if best[1] else best[2], len(members),
                        hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1, 7, 2048])
def test_against_brute_force(spark, block):
    rows = awkward() if block > 1 else [(i, (t or "")[:40], *r) for i, t, *r in awkward()]
    got = exact_dedup(frame(spark, rows), block_bytes=block).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(rows)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}


def test_blocks_that_only_differ_in_order_or_length(spark):
    a, b = text(400, 5), text(400, 6)
    rows = [(1, a + b, "", ""), (2, b + a, "", ""), (3, a, "", ""), (4, a + a, "", ""), (5, a + a, "", "")]
    got = {r.doc_id: r.keep_id for r in exact_dedup(frame(spark, rows), block_bytes=16).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4}


def test_hot_group_is_salted_and_whole(spark, monkeypatch):
    import blotter.llm.exact_dedup as module
    monkeypatch.setattr(module, "HOT", 4)
    rows = [(i, "same text for all of them" * 3, "", "") for i in range(200)] + [(500 + i, f"own {i}", "", "") for i in range(50)]
    got = exact_dedup(frame(spark, rows), block_bytes=8).collect()
    assert sorted(r.group_size for r in got) == [1] * 50 + [200] * 200
    assert {r.keep_id for r in got if r.group_size == 200} == {0}


def test_empty_table(spark):
    assert exact_dedup(frame(spark, []).limit(0)).collect() == []


def test_oracle(spark, sf_small):
    from oracle_harness import compare, duck
    out = compare(spark, duck(sf_small), "op4", Q.op4_exact_dedup, Q.oracle_sql()["op4_exact_dedup"], sf_small)
    assert out["hash_match"] and out["cols_match"], out


def test_main_path_has_no_python(spark):
    plan = exact_dedup(frame(spark, awkward()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
