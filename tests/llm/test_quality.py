import numpy as np
import pytest

from blotter.llm import queries as Q
from blotter.llm.quality import CHUNK, HALF, PIECE, STRIDE, WIDTH, fit_quality, mean_logits, score_quality, train
from fixtures import awkward, frame, text

SPAM = "!!".join("BUY NOW CHEAP " * 30)


def corpus(n=80):
    return [(i, text(60 + i, i) if i % 2 else "BUY!! " * (20 + i), "", "") for i in range(n)]


@pytest.fixture(scope="module")
def net():
    rows = corpus()
    return train([t.encode() for _, t, *_ in rows], np.array([i % 2 for i, *_ in rows]), epochs=4)


def plain_logit(net, text: bytes) -> float:
    """The network by its definition, one window at a time."""
    halves = max(1, -(-len(text) // HALF))
    data = text.ljust(halves * HALF + WIDTH, b"\0")
    best = []
    for h in range(halves):
        windows = [sum(net.filters[k, data[at + k]] for k in range(WIDTH)) for at in range(h * HALF, (h + 1) * HALF, STRIDE)]
        best.append(np.maximum(np.max(windows, axis=0) + net.bias, 0))
    chunks = [np.maximum(a, b) for a, b in zip(best, best[1:])] or best
    return float(np.mean([net.logits(c) for c in chunks]))


def test_fast_scoring_equals_the_definition(net):
    texts = [t.encode() for t in ["", "a", text(20, 1), text(90, 2), "é" * 300, "x" * CHUNK, "y" * (CHUNK + 1), SPAM]]
    assert np.allclose(mean_logits(net, texts), [plain_logit(net, t) for t in texts], atol=1e-3)


def test_very_long_texts_are_scored_whole(net, monkeypatch):
    import blotter.llm.quality as module
    long = (text(900, 4) + SPAM + text(900, 5)).encode()
    whole = mean_logits(net, [long])
    monkeypatch.setattr(module, "PIECE", 4 * CHUNK)
    assert np.allclose(mean_logits(net, [long, b"", long]), [whole[0], mean_logits(net, [b""])[0], whole[0]], atol=1e-3)
    assert PIECE % HALF == 0


def test_learns_and_repeats(net):
    rows = corpus()
    again = train([t.encode() for _, t, *_ in rows], np.array([i % 2 for i, *_ in rows]), epochs=4)
    assert np.array_equal(net.filters, again.filters) and net.scale == again.scale
    p = net.probability(mean_logits(net, [text(100, 900).encode(), b"BUY!! " * 33]))
    assert p[0] > 0.7 > p[1]


def test_one_class_or_no_labels_answers_the_share():
    none = train([], np.array([]))
    assert none.probability(mean_logits(none, [b"x"]))[0] == pytest.approx(0.5)
    ones = train([b"a", b"b"], np.array([1, 1]))
    assert ones.probability(mean_logits(ones, [b"x"]))[0] == pytest.approx(0.75)


def test_awkward_rows(spark, net):
    got = score_quality(frame(spark, awkward()), net).collect()
    assert len(got) == len(awkward())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[5] == by[6]  # null scores like empty


def test_fit_uses_neither_held_out_rows_nor_other_columns(spark):
    import zlib
    rows = corpus(120)
    labels = [(i, i % 2, 0, "x") for i, *_ in rows] + [(None, 1, 0, "x"), (5, None, 0, "x"), (900, 1, 0, "x")]
    # Held-out rows carry the opposite label: they must not matter.
    turned = [(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 4 == 2 else q, t, x)
              for i, q, t, x in labels]
    schema = "doc_id long, quality int, toxic int, text string"
    a = fit_quality(frame(spark, rows), spark.createDataFrame(labels, schema), max_per_class=30)
    b = fit_quality(frame(spark, [(i, t, "zz", f"s{i}") for i, t, *_ in rows]), spark.createDataFrame(turned, schema),
                    max_per_class=30)
    assert np.array_equal(a.filters, b.filters)


def test_empty_tables(spark, net):
    assert score_quality(frame(spark, []).limit(0), net).collect() == []
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fit_quality(frame(spark, []).limit(0), empty).scale == 0


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in Q.op7_quality_classifier(spark, sf).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    good = np.array([rows[i].score for i, q in labels if q == 1 and rows[i].held_out])
    bad = np.array([rows[i].score for i, q in labels if q == 0 and rows[i].held_out])
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert (good >= 0.7).mean() > 0.95 and (bad >= 0.7).mean() < 0.25
