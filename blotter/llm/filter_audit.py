"""Filter interaction audit by contingency tensor contractions.

Spark reduces the documents to how many of each part fail each combination of
filters: at most 2^k cells a part. A part's cells are reshaped to a tensor with
one axis of length two (pass, fail) per filter. Every count of every step of
every order is then one contraction: along each axis a selector takes pass,
fail or all, and ``einsum`` sums the product.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut

#: Cells of one measure (documents, quality 1, toxic 1) lie on one axis.
MEASURES = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: Parts whose tensors are contracted together in a task.
PARTS_AT_ONCE = 64


def text_failures(words: Column, text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text."""
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals.cast("long") * 100 > F.char_length(text).cast("long") * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }


def filter_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """``part, pattern, n, good, toxic``: documents by the filters A to E that
    they fail (bit i of ``pattern``: the i-th letter) and by label.

    Texts are read once. What is shuffled is one narrow row a document (id,
    digest of the text, part, bits), already summed over repeated rows. E, a
    copy of a text with a smaller id, is found by a join on digest *and* id with
    the smallest id of each digest, so a large group of copies is spread by its
    ids and never meets in one task.

    A null text is empty, a null part the empty string. A row without an id is
    no copy and has no label, and no other row is a copy of it; rows that repeat
    an id are documents of their own, copies only of smaller ids. A document
    with several label rows counts as good or toxic if any of them says so.
    Other columns are not read. An empty table gives no rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    fails = text_failures(F.col("words"), F.col("text"))
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails.values())), F.lit(0))
    facts = cut(rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("bits"))
                .groupBy("id", "digest", "part", "bits").agg(F.count(F.lit(1)).alias("n")), "audit_facts")
    firsts = (facts.groupBy("digest").agg(F.min("id").alias("id")).filter("id IS NOT NULL")
              .withColumn("first", F.lit(True)))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    pattern = F.col("bits") + F.when(copy, 1 << len(fails)).otherwise(0)
    n = F.col("n")
    return (facts.join(firsts, ["digest", "id"], "left").join(marks, "id", "left")
            .groupBy("part", pattern.alias("pattern"))
            .agg(F.sum("n").alias("n"), F.sum(n * F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(n * F.coalesce("toxic", F.lit(0))).alias("toxic")))


def selectors(names: str) -> tuple[list[tuple[str, int, int]], dict[str, np.ndarray]]:
    """Steps ``(order, step, filter)`` of all orders, and for each count an
    array (step, axis, 2) of what it selects along each axis."""
    k = len(names)
    pass_, fail, all_ = (1, 0), (0, 1), (1, 1)
    steps, picks = [], {c: [] for c in ("kept", "removed", "failed", "unique")}
    for order in itertools.permutations(range(k)):
        for at, f in enumerate(order):
            earlier = set(order[:at])
            before = [pass_ if a in earlier else all_ for a in range(k)]
            steps.append(("".join(names[a] for a in order), at + 1, f))
            picks["kept"].append([pass_ if a == f else before[a] for a in range(k)])
            picks["removed"].append([fail if a == f else before[a] for a in range(k)])
            picks["failed"].append([fail if a == f else all_ for a in range(k)])
            picks["unique"].append([fail if a == f else pass_ for a in range(k)])
    return steps, {c: np.array(p, np.int64) for c, p in picks.items()}


def contract(cells: np.ndarray, names: str) -> dict[str, np.ndarray]:
    """Counts (part, step) out of ``cells`` (part, measure, 2^k)."""
    k = len(names)
    steps, picks = selectors(names)
    axes = "abcdefgh"[:k]
    tensor = cells.reshape(*cells.shape[:2], *[2] * k)

    def along(pick: np.ndarray, measure: int) -> np.ndarray:
        spec = f"p{axes}," + ",".join(f"r{a}" for a in axes) + "->pr"
        return np.einsum(spec, tensor[:, measure], *(pick[:, a] for a in range(k)), optimize=True)

    removed = along(picks["removed"], 0)
    out = {"kept": along(picks["kept"], 0), "removed": removed, "redundant": along(picks["failed"], 0) - removed,
           "unique_fails": along(picks["unique"], 0), "good_lost": along(picks["removed"], 1),
           "toxic_lost": along(picks["removed"], 2)}
    filters = np.array([f for _, _, f in steps])
    share = np.stack([removed[:, filters == f].sum(axis=1) for f in range(k)], axis=1)
    return {**out, "shapley": share[:, filters]}


def audit_filters(cells: DataFrame, names: str = "ABCDE") -> DataFrame:
    """``part, filter_order, step`` and the counts of ``COUNTS`` for each part
    of ``cells(part, pattern, n, good, toxic)``, each order of ``names`` and
    each step, zeros included. ``pattern`` holds one bit a filter.

    A part comes as one row of at most 2^k cells, so a task holds a few
    hundred rows at a time however many documents they stand for."""
    k = len(names)
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("pattern", *MEASURES)).alias("cells"))
    steps, _ = selectors(names)
    orders, numbers = [s[0] for s in steps], np.array([s[1] for s in steps], np.int32)
    # Axis i of the tensor is filter i; the last axis runs fastest, so bit i of
    # a pattern moves to place k-1-i.
    place = [sum(((p >> i) & 1) << (k - 1 - i) for i in range(k)) for p in range(1 << k)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), PARTS_AT_ONCE):
                some = batch.iloc[at:at + PARTS_AT_ONCE]
                table = np.zeros((len(some), len(MEASURES), 1 << k), np.int64)
                for p, found in enumerate(some["cells"]):
                    for cell in found:
                        table[p, :, place[cell["pattern"]]] = [cell[m] for m in MEASURES]
                counts = contract(table, names)
                yield pd.DataFrame({"part": np.repeat(some["part"].to_numpy(object), len(steps)),
                                    "filter_order": orders * len(some), "step": np.tile(numbers, len(some)),
                                    **{c: counts[c].ravel() for c in COUNTS}})

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    return packed.mapInPandas(run, schema)
