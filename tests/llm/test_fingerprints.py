import hashlib
import math
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from blotter.llm import queries as Q
from blotter.llm.fingerprints import fingerprint_edits, likeness, signatures
from fixtures import awkward, frame, split, text, words

MASK = (1 << 32) - 1


def xx(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64(data, seed=seed).intdigest()


def long(v: int) -> bytes:
    return (v & (1 << 64) - 1).to_bytes(8, "little")


def signature(bag: dict[str, int], samples: int) -> str:
    if not bag:
        return ""
    bits = lambda h, at, n: (h >> at & (1 << n) - 1) + 0.5
    ln2 = 0.6931471805599453
    out = []
    for i in range(samples):
        best = []
        for word, weight in bag.items():
            term = xx(word.encode())
            h = xx(long(i), xx(long(term)))
            g = xx(long(h))
            r = 42 * ln2 - math.log(bits(h, 0, 21) * bits(h, 21, 21))
            c = 64 * ln2 - math.log(bits(g, 0, 32) * bits(g, 32, 32))
            b = bits(h, 42, 22) * 0.5 ** 22
            t = math.floor(math.log(weight) / r + b)
            value = math.log(c) - r * (t - b + 1)
            best.append((math.floor(value * 2 ** 20), xx(long(t), xx(long(term))) & MASK))
        out.append(f"{min(best)[1]:08x}")
    return "".join(out)


def like(a: str, b: str, samples: int) -> float:
    if not a or not b:
        return float(a == b)
    return sum(a[8 * i:8 * i + 8] == b[8 * i:8 * i + 8] for i in range(samples)) / samples


def brute(rows, samples):
    one = {}
    for i, t, *_ in rows:
        t = t or ""
        key = hashlib.sha256(f"{'-' if i is None else i}:{t}".encode()).digest()
        n = one.get(key, (None, None, 0))[2]
        one[key] = (i, t, n + 1)
    order = sorted(one, key=lambda k: (one[k][0] is None, -(one[k][0] or 0), k))
    out = []
    for at, key in enumerate(order):
        i, t, copies = one[key]
        nxt = one[order[(at + 1) % len(order)]][1]
        third = len(t) // 3
        edited = t[:len(t) - third] + nxt[:third]
        own, edit, other = (signature(Counter(split(x)), samples) for x in (t, edited, nxt))
        out += copies * [(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, edit,
                          like(own, edit, samples), like(own, other, samples))]
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = [(i, " ".join(t.split(" ")[:400]) if t and len(t) > 9000 else t, *r) for i, t, *r in awkward()]
    got = fingerprint_edits(frame(spark, rows), samples=8).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 8)


@pytest.mark.parametrize("rows", [[(1, "alone in the table", "", "")], [(1, None, "", "")], [(1, "ab", "", ""), (2, "c d e f g h", "", "")]])
def test_small_tables(spark, rows):
    assert sorted(map(tuple, fingerprint_edits(frame(spark, rows), samples=4).collect()), key=str) == brute(rows, 4)


def test_empty_table(spark):
    assert fingerprint_edits(frame(spark, []).limit(0)).collect() == []


def test_equal_texts_and_a_very_long_one(spark):
    rows = [(k, "one two two three", "", "") for k in range(50)] + [(99, text(60_000, 2), "", "")]
    got = fingerprint_edits(frame(spark, rows)).collect()
    assert len({r.fingerprint for r in got if r.doc_id < 99}) == 1 and {len(r.fingerprint) for r in got} == {8 * 48}
    assert [r.near_next for r in got if 0 < r.doc_id < 50] == [1.0] * 49


def test_likeness_estimates_generalised_jaccard(spark):
    """Over many pairs of bags with real weights, the mean error is that of the
    number of samples."""
    import random
    r = random.Random(3)
    rows, exact = [], {}
    for pair in range(60):
        vocabulary = words(40, pair)
        a = {w: r.random() * 10 ** r.randint(-3, 6) for w in vocabulary[:30]}
        b = {w: a.get(w, 1.0) * r.choice([0.2, 1, 1, 1, 3]) for w in vocabulary[r.randint(0, 15):]}
        both = set(a) | set(b)
        exact[pair] = sum(min(a.get(w, 0), b.get(w, 0)) for w in both) / sum(max(a.get(w, 0), b.get(w, 0)) for w in both)
        rows += [(pair, w, a.get(w, 0.0), b.get(w, 0.0)) for w in both]
    terms = spark.createDataFrame(rows, "k long, word string, a double, b double").withColumn("term", F.xxhash64("word"))
    got = {x.k: x.near for x in signatures(terms, "k", {"a": "sa", "b": "sb"}, 128).select(
        "k", likeness(F.col("sa"), F.col("sb")).alias("near")).collect()}
    errors = [got[k] - exact[k] for k in exact]
    assert abs(sum(errors) / len(errors)) < 0.02
    assert max(map(abs, errors)) < 0.2 and sum(e * e for e in errors) / len(errors) < 0.044 ** 2 * 1.5


def test_query(spark, sf_small):
    got = Q.op12_document_fingerprints(spark, sf_small).collect()
    assert len(got) == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    mean = lambda c: sum(r[c] for r in got) / len(got)
    assert mean("near_edited") > mean("near_next") + 0.2


def test_main_path_has_no_python(spark):
    plan = fingerprint_edits(frame(spark, awkward()), samples=4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
