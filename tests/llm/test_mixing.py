from collections import defaultdict

import pytest

from blotter.llm import queries as Q
from blotter.llm.mixing import mix_blocks, mix_sources, source_targets
from fixtures import awkward, frame, split, text


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0):
    """By the rule: cap, share the excess among the others, until none is above."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(w[s] for s in open_)
        above = {s for s in open_ if unit * w[s] >= most * sizes[s]}
        if not above:
            return out | {s: unit * w[s] for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= above
    return out


def check(rows, got, exact=True):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(split(t))
    want = targets(sizes)
    source = {i: s for i, _, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        assert r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
    for s in sizes:
        assert want[s] - 1 - 1e-6 <= taken[s] <= want[s] + 1e-6, (s, taken[s], want[s])
    return want


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 50}, {"a": 5, "b": 5, "c": 5, "d": 1000, None: 7},
                                   {"x": 0, "y": 10}, {"z": 3}, {"é": 40, "z": 40, "a": 40, "Z": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))


def documents():
    return [(i, text(5 + i * 7 % 400, i), "en", ["hot", "b", "c", None][0 if i % 3 else i % 4]) for i in range(200)]


def test_mix_reaches_targets(spark):
    rows = documents()
    check(rows, mix_sources(frame(spark, rows)).collect())


def test_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] is not None and r[0] != 2] + [(2, text(120, 1), "en", "b")]
    check(rows, mix_sources(frame(spark, rows)).collect())
    all_rows = mix_sources(frame(spark, awkward())).collect()
    assert len(all_rows) == len(awkward())


def test_reruns_agree_in_any_order(spark):
    rows = documents()
    a = mix_sources(frame(spark, rows)).collect()
    b = mix_sources(frame(spark, rows[::-1]).repartition(7)).collect()
    key = lambda r: (r.doc_id, r.size, r.taken)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_schedule_is_spread_evenly_and_blocks_are_equal(spark):
    rows = documents()
    _, pieces = mix_blocks(frame(spark, rows), block=16)
    slots = defaultdict(lambda: [None, 0])
    for p in pieces.collect():
        assert p.to_word > p.from_word
        slots[p.slot][0] = p.source_no
        slots[p.slot][1] += p.to_word - p.from_word
    assert max(n for _, n in slots.values()) == 16
    order = [slots[s][0] for s in sorted(slots)]
    # Any window of slots has each source's share, give or take a few.
    for source in set(order):
        share = order.count(source) / len(order)
        for size in (32, 128):
            for at in range(0, len(order) - size, size):
                assert abs(order[at:at + size].count(source) - share * size) <= 6


def test_empty_table(spark):
    assert mix_sources(frame(spark, []).limit(0)).collect() == []
    got = mix_sources(frame(spark, [(1, None, "", "a"), (2, " ", "", None)])).collect()
    assert sorted((r.doc_id, r.size, r.taken) for r in got) == [(1, 0, 0), (2, 0, 0)]


def test_query_on_small_tables(spark, sf_small):
    rows = [(d.doc_id, d.text, d.lang, d.source) for d in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    check(rows, Q.op9_source_mix(spark, sf_small).collect())
