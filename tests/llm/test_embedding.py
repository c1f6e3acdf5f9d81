import math

import numpy as np
import pytest

from blotter.llm import queries as Q
from blotter.llm.embedding import THRESHOLD, embedding_dedup, survivors, unit
from fixtures import components

SCHEMA = "vec_id long, embedding array<float>, label int, node long, links long"


def brute(rows):
    ok = [v is not None and lab is not None and i is not None and len(v) > 0
          and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v, lab, *_ in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= THRESHOLD:
                    links.append((a, b))
    root = components(len(rows), links)
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    out = []
    for i, (vec, *_) in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None), default=None)
        out.append((vec, n[i], least))
    return sorted(out, key=str)


def clustered(n, dim, seed, spread):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(1, n // 12), dim))
    return [(i, (centres[r.integers(len(centres))] + r.normal(size=dim) * spread).astype(np.float32).tolist(),
             int(r.integers(3)), 1, 1) for i in range(n)]


def result(df):
    rows = embedding_dedup(df).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("dim,spread", [(3, 0.1), (16, 0.25), (64, 0.3)])
def test_against_brute_force(spark, dim, spread, monkeypatch):
    import blotter.llm.embedding as module
    monkeypatch.setattr(module, "TILE", 16)
    rows = clustered(240, dim, dim, spread)
    rows += [(1000 + k, rows[5][1], rows[5][2], 1, 1) for k in range(40)]  # copies
    want = brute(rows)
    assert sum(n for _, n, _ in want) > 1000
    assert result(spark.createDataFrame(rows, SCHEMA)) == want


def test_awkward_rows(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, v, 0, 1, 1), (2, [2 * x for x in v], 0, 1, 1), (3, v, 1, 1, 1), (4, v, None, 1, 1), (5, None, 0, 1, 1),
            (6, [0.0] * 4, 0, 1, 1), (7, [1.0, None, 3.0, 4.0], 0, 1, 1), (8, [1.0, float("nan"), 3.0, 4.0], 0, 1, 1),
            (9, [1.0, float("inf"), 3.0, 4.0], 0, 1, 1), (10, [], 0, 1, 1), (11, v[:3], 0, 1, 1), (12, v[:3], 0, 1, 1),
            (13, [3e38, 3e38, 3e38, 3e38], 0, 1, 1), (14, [1e-38] * 4, 0, 1, 1), (1, v, 0, 1, 1),
            (15, [-0.0, 1.0, 0.0, 0.0], 0, 1, 1), (16, [0.0, 1.0, 0.0, -0.0], 0, 1, 1), (17, [-x for x in v], 0, 1, 1)]
    got = {}
    for r in embedding_dedup(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.vec_id, set()).add((r.n_links, r.component_id, r.kept))
    for alone in (3, 4, 5, 6, 7, 8, 9, 10, 17):
        assert got[alone] == {(0, alone, True)}, alone
    assert got[1] == {(2, 1, True)} and got[2] == {(2, 1, False)}
    assert got[11] == {(1, 11, True)} and got[12] == {(1, 11, False)}
    assert got[13] == {(1, 13, True)} and got[14] == {(1, 13, False)}
    assert got[15] == {(1, 15, True)} and got[16] == {(1, 15, False)}


def test_bounds_never_lose_a_pair():
    r = np.random.default_rng(1)
    a, b = unit(r.normal(size=(80, 20))), unit(r.normal(size=(90, 20)))
    for t in (0.2, 0.5, 0.93):
        i, j = survivors(a, b, t)
        have = set(zip(i.tolist(), j.tolist()))
        assert {(x, y) for x, y in zip(*np.nonzero(a @ b.T >= t))} <= have


def test_empty_table(spark):
    assert embedding_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_small_tables(spark, sf_small):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in Q.op5_embedding_dedup(spark, sf_small).collect()), key=str)
    assert got == brute(rows)


def test_oracle(spark, sf_small):
    from oracle_harness import compare, duck
    out = compare(spark, duck(sf_small), "op5", Q.op5_embedding_dedup, Q.oracle_sql()["op5_embedding_dedup"], sf_small)
    assert out["hash_match"] and out["cols_match"], out
