import itertools
from collections import defaultdict

import numpy as np

from blotter.llm import queries as Q
from blotter.llm.packing import best_boundaries, pack
from fixtures import awkward, frame, split, text


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    r = np.random.default_rng(1)
    for _ in range(40):
        lengths = np.sort(r.choice(60, r.integers(1, 10), replace=False)) + 1
        counts = r.integers(1, 50, len(lengths))
        k = int(r.integers(1, 5))
        ends = best_boundaries(lengths, counts, k)
        best = min(padding(lengths, counts, [*c, lengths[-1]])
                   for n in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], n))
        assert ends[-1] == lengths[-1] and len(ends) <= k
        assert padding(lengths, counts, ends) == best
    assert best_boundaries(np.array([]), np.array([]), 4) == []


def check(rows, got, max_words, budget):
    sizes = [len(split(t)) for _, t, *_ in rows]
    assert sum(r.n_words for r in got) == sum(sizes)
    by = defaultdict(list)
    for r in got:
        by[r.row].append(r)
    assert sorted(sum(r.n_words for r in v) for v in by.values()) == sorted(s for s in sizes if s)
    for v in by.values():
        v.sort(key=lambda r: r.piece)
        assert [r.first_word for r in v] == [max_words * k for k in range(len(v))]
        assert all(r.n_words == max_words for r in v[:-1])
    batches = defaultdict(list)
    for r in got:
        assert r.padding == r.bucket_words - r.n_words >= 0
        batches[r.batch_id].append(r)
    for v in batches.values():
        assert len({r.bucket_words for r in v}) == 1
        assert sorted(r.place for r in v) == list(range(len(v)))
        assert len(v) == 1 or len(v) * v[0].bucket_words <= budget
    # Only the last batch of a bucket may have room.
    for bucket, v in itertools.groupby(sorted(batches), key=lambda b: b[:3]):
        full = [len(batches[b]) for b in v]
        assert len(set(full[:-1])) <= 1


def test_awkward_rows(spark):
    rows = awkward() + [(100 + i, text(1 + i % 37, i), "", "") for i in range(300)]
    got = pack(frame(spark, rows), max_words=64, buckets=5, budget=256).collect()
    check(rows, got, 64, 256)
    assert not {5, 6, 7} & {r.doc_id for r in got}


def test_empty_table(spark):
    assert pack(frame(spark, []).limit(0)).collect() == []
    assert pack(frame(spark, [(1, None, "", ""), (2, " ", "", "")])).collect() == []


def test_query_on_small_tables(spark, sf_small):
    docs = [(d.doc_id, d.text, d.lang, d.source) for d in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = pack(spark.read.parquet(f"{sf_small}/documents.parquet")).collect()
    check(docs, got, 1024, 32_768)
    lengths, counts = np.unique([r.n_words for r in got], return_counts=True)
    ends = sorted({r.bucket_words for r in got})
    assert ends == best_boundaries(lengths, counts, 16)
    # The boundaries beat equal shares of the rows.
    shares = np.quantile(np.repeat(lengths, counts), np.arange(1, 17) / 16, method="higher")
    assert padding(lengths, counts, ends) <= padding(lengths, counts, shares)
    assert Q.op8_packing(spark, sf_small).count() == len(got)
