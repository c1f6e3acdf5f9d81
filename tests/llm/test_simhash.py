import itertools
import random

import numpy as np

from blotter.llm import queries as Q
from blotter.llm.buckets import linked_components
from blotter.llm.graph import connected_components
from blotter.llm.simhash import RADIUS, covering_masks, simhash, simhash_dedup
from fixtures import awkward, components, fingerprint, frame, text


def brute(rows):
    fps = [fingerprint(t) for _, t, *_ in rows]
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if (fps[a] ^ fps[b]).bit_count() <= RADIUS]
    root = components(len(rows), links)
    out = []
    for i, (doc, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((doc, f"{fps[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def test_masks_cover_every_pattern_within_the_radius():
    masks = covering_masks()
    assert len(masks) == 2 ** (RADIUS + 1) - 1
    r = random.Random(1)
    for n in range(RADIUS + 1):
        for _ in range(3000):
            difference = sum(1 << b for b in r.sample(range(64), n))
            assert any(difference & m == 0 for m in masks)


def test_fingerprint_against_definition():
    for t in ["", "One", "One two THREE", "a b c d", "a b c É D e", text(500, 1)]:
        assert simhash(t.encode()) == fingerprint(t)


def test_awkward_rows(spark):
    rows = awkward()
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_near_copies_against_brute_force(spark):
    r, rows = random.Random(3), []
    for i in range(150):
        w = text(300, i % 30).split()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w), "", ""))
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_buckets_longer_than_a_stretch(spark, monkeypatch):
    """Many fingerprints in one small ball: the later passes do the work."""
    import blotter.llm.buckets as module
    monkeypatch.setattr(module, "STRETCH", 8)
    monkeypatch.setattr(module, "HOLD", 16)
    r = random.Random(5)
    centre = r.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in r.sample(range(0, 64, 2), r.randint(0, 7))) for _ in range(250)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    masks = [m - (1 << 64) if m >> 63 else m for m in covering_masks()]
    members = spark.createDataFrame([(k, s & m, s) for s in signed for k, m in enumerate(masks)],
                                    "table int, key long, node long")
    got = {r.node: r.component for r in linked_components(members, RADIUS).collect()}
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= RADIUS
    root = components(len(fps), zip(*np.nonzero(np.triu(near, 1))))
    want = {}
    for i, s in enumerate(signed):
        want.setdefault(root[i], []).append(s)
    for group in want.values():
        assert {got.get(s, s) for s in group} == {min(group)}


def test_bucket_goes_on_after_a_batch_that_was_flushed(monkeypatch):
    """The rest of a bucket too long to hold stays open, whatever its length."""
    import pyarrow as pa

    import blotter.llm.buckets as module
    monkeypatch.setattr(module, "HOLD", 8)
    for rest in (1, 2, 5):
        rows = [(0, 1, 100)] + [(0, 5, 1000 * i) for i in range(8 + rest)] + [(0, 6, 7)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
            zip(*part), (pa.int32(), pa.int64(), pa.int64()))], ["table", "key", "node"]) for part in (rows[:9], rows[9:])]
        out = [tuple(r.values()) for b in module._walk(RADIUS)(iter(batches)) for r in b.to_pylist()]
        assert {b for kind, _, a, b in out if kind == 1 and a == 5} == {1000 * i for i in range(8 + rest)}


def test_components_of_long_chain_star_and_noise(spark):
    pairs = [(i, i + 1) for i in range(1, 300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 4000), (7, 7), (None, 1)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 301)} == {1}
    assert {got[1000 + i] for i in range(300)} == {1000}
    assert got[5000] == got[4000] == 4000


def test_empty_table(spark):
    assert simhash_dedup(frame(spark, []).limit(0)).collect() == []
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query_on_small_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    rows = [(d.doc_id, d.text, d.lang, d.source) for d in docs]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in Q.op3_simhash_dedup(spark, sf_small).collect()]
    assert sorted(got, key=str) == brute(rows)
