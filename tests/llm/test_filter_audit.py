import itertools
import re

from pyspark.sql import functions as F

from blotter.llm import queries as Q
from blotter.llm.filter_audit import COUNTS, audit_filters, filter_cells
from fixtures import awkward, frame, split, text


def brute(rows, labels):
    """Every order applied to every part, document by document."""
    texts = [(i, t or "", s or "") for i, t, _, s in rows]
    fails = []
    for i, t, _ in texts:
        w = split(t)
        own = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
               "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
               "E": i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)}
        fails.append({f for f, bad in own.items() if bad})
    good = {d for d, q, _ in labels if q == 1 and d is not None}  # a row without an id has no label
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out, shapley = {}, {}
    for part in {s for *_, s in texts}:
        own = [(i, f) for (i, _, s), f in zip(texts, fails) if s == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                failed = sum(f in x[1] for x in own)
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failed - len(gone), sum(x[1] == {f} for x in own),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def labels_frame(spark, labels):
    return spark.createDataFrame([(*x, "clash", 1) for x in labels], "doc_id long, quality int, toxic int, part string, n int")


def run(spark, rows, labels):
    got = audit_filters(filter_cells(frame(spark, rows), labels_frame(spark, labels))).collect()
    assert len({(r.part, r.filter_order, r.step) for r in got}) == len(got)
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in got}


def test_against_every_order_document_by_document(spark):
    rows = awkward() + [
        (20, "ONE TWO $", "en", "a"), (21, "ONE TWO $", "en", "b"), (19, "ONE TWO $", "en", ""),
        (30, " ".join(["same"] * 300), "en", "a"), (31, text(400, 9), "en", "a"), (32, text(400, 9), "de", "ü"),
        (32, text(400, 9), "de", "ü"), (33, "Ä" * 50 + " A|", "de", "b")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (21, 1, 1), (30, 0, 1), (32, 1, None), (None, 1, 1), (99, 1, 1), (8, None, None)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_no_labels_and_one_large_group_of_copies(spark):
    rows = [(i, "a copy of this text " * 3, "en", "hot") for i in range(300)] + [(1000 + i, text(250, i), "en", f"s{i}") for i in range(5)]
    assert run(spark, rows, []) == brute(rows, [])


def test_empty_table(spark):
    cells = filter_cells(frame(spark, []).limit(0), labels_frame(spark, []))
    assert cells.collect() == [] and audit_filters(cells).collect() == []


def test_other_numbers_of_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 2, 0, 1), ("p", 3, 4, 4, 0)],
                                  "part string, pattern int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost) for r in
           audit_filters(cells, "XY").collect()}
    assert got == {("XY", 1): (5, 6, 0, 2, 4), ("XY", 2): (5, 0, 4, 0, 0), ("YX", 1): (7, 4, 0, 0, 4), ("YX", 2): (5, 2, 4, 2, 0)}


def test_texts_stay_out_of_the_shuffles(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    cells = filter_cells(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    assert "text" not in cells._jdf.queryExecution().executedPlan().toString()  # the written facts have digests only
    assert cells.agg(F.sum("n")).first()[0] == docs.count()


def test_oracle(spark, sf_small):
    from oracle_harness import compare, duck
    out = compare(spark, duck(sf_small), "op11", Q.op11_filter_audit, Q.oracle_sql()["op11_filter_audit"], sf_small)
    assert out["hash_match"] and out["cols_match"], out
