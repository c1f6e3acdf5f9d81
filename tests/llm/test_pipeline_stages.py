import itertools
import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
from blotter.llm.common import cut
from fixtures import awkward, components, fingerprint, frame, split, text
from test_mixing import targets

STAGES = dict(corpus_pipeline.STAGES)


def run(spark, name, df, sf_dir="/root/testdata/sf0.001"):
    return cut(STAGES[name](spark, cut(df, "in"), sf_dir), "out")


def as_rows(df):
    return [tuple(r) for r in df.collect()]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def exact_brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r)
    return [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]


def near_brute(rows):
    fps = [fingerprint(r[1]) for r in rows]
    root = components(len(rows), [(a, b) for a, b in itertools.combinations(range(len(rows)), 2)
                                  if (fps[a] ^ fps[b]).bit_count() <= 4])
    groups = defaultdict(list)
    for r, g in zip(rows, root):
        groups[g].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def ids(rows):
    return sorted((r[0], norm(r[1])) for r in rows) if all(r[0] is not None for r in rows) else sorted(
        (str(r[0]), norm(r[1])) for r in rows)


def test_exact_stage(spark):
    got = run(spark, "exact_dedup", frame(spark, awkward()))
    assert got.columns == frame(spark, []).columns
    assert ids(as_rows(got)) == ids(exact_brute(awkward()))


def test_near_stage(spark):
    got = run(spark, "simhash_near_dedup", frame(spark, awkward()))
    assert got.columns == frame(spark, []).columns
    want = near_brute(awkward())
    assert sorted(str(r[0]) for r in as_rows(got)) == sorted(str(r[0]) for r in want)


def test_mix_stage(spark):
    rows = [(i, text(5 + i * 7 % 300, i) + " \n", "en", ["hot", "b", "c", None][0 if i % 3 else i % 4]) for i in range(120)]
    rows += [rows[3], rows[3], (500, None, "en", "b"), (501, "  ", None, None)]
    df = frame(spark, rows)
    got = run(spark, "source_mix", df)
    assert got.columns == df.columns
    sizes, taken, texts = Counter(), Counter(), defaultdict(list)
    for _, t, _, s in rows:
        sizes[s] += len(split(t))
    for i, t, _, s in rows:
        texts[i].append(t)
    for r in got.collect():
        taken[r.source] += len(split(r.text))
        whole = texts[r.doc_id][0]
        assert r.text == whole or whole.startswith(r.text)  # parts keep their white space
        assert r.n_chars == len(r.text)
    want = targets(dict(sizes))
    assert all(math.floor(want[s] + 1e-9) == taken[s] for s in sizes)
    uses = Counter(r.doc_id for r in got.collect())
    assert all(n <= 2 * len(texts[i]) for i, n in uses.items())


def test_quality_and_packing_stages_on_awkward_rows(spark):
    df = frame(spark, awkward())
    got = run(spark, "quality_classifier", df)
    assert got.columns == df.columns and {r.doc_id for r in got.collect()} <= {r[0] for r in awkward()}
    packed = run(spark, "packing", df)
    assert sum(r.n_words for r in packed.collect()) == sum(len(split(t)) for _, t, *_ in awkward())


def test_all_stages_on_an_empty_table(spark):
    for name in STAGES:
        assert run(spark, name, frame(spark, []).limit(0)).collect() == []


def test_pipeline_against_brute_force(spark, sf_small):
    """Each stage on the whole result of the one before it."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    good = cut(STAGES[names[0]](spark, docs, sf_small), "s0")
    kept = {r.doc_id for r in good.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    exact = cut(STAGES[names[1]](spark, good, sf_small), "s1")
    assert ids(as_rows(exact)) == ids(exact_brute(as_rows(good)))
    near = cut(STAGES[names[2]](spark, exact, sf_small), "s2")
    assert ids(as_rows(near)) == ids(near_brute(as_rows(exact)))
    mixed = cut(STAGES[names[3]](spark, near, sf_small), "s3")
    sizes, taken = Counter(), Counter()
    for r in near.collect():
        sizes[r.source] += len(split(r.text))
    for r in mixed.collect():
        taken[r.source] += len(split(r.text))
    want = targets(dict(sizes))
    assert all(want[s] - 1 <= taken[s] <= want[s] for s in sizes)
    packed = cut(STAGES[names[4]](spark, mixed, sf_small), "s4")
    assert sum(r.n_words for r in packed.collect()) == sum(taken.values())
    assert corpus_pipeline.run(spark, sf_small).count() == packed.count()
