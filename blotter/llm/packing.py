"""Packing sequences into batches by optimal length buckets.

Documents are cut into sequences of at most ``max_words`` words. A dynamic
programme over the global histogram of sequence lengths chooses the bucket
boundaries that minimise padding when every sequence is padded to its bucket's
boundary. Inside a bucket, batches are filled to a budget of padded words.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, running_total, word_count


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Boundaries (each the largest length of its bucket, ascending) with the
    least padding in all; fewer when there are fewer lengths."""
    n = len(lengths)
    if n == 0:
        return []
    buckets = min(buckets, n)
    lengths, counts = lengths.astype(np.float64), counts.astype(np.float64)
    rows = np.concatenate([[0.0], np.cumsum(counts)])
    words = np.concatenate([[0.0], np.cumsum(counts * lengths)])
    # cost[j]: least padding of the first j lengths in the buckets so far.
    cost = np.full(n + 1, np.inf)
    cost[0] = 0
    choice = np.zeros((buckets, n + 1), np.int64)
    for b in range(buckets):
        new = np.full(n + 1, np.inf)
        for j in range(b + 1, n + 1):
            i = np.arange(b, j)
            pad = lengths[j - 1] * (rows[j] - rows[i]) - (words[j] - words[i])
            total = cost[b:j] + pad
            best = int(total.argmin())
            new[j], choice[b, j] = total[best], b + best
        cost = new
    out, j = [], n
    for b in range(buckets - 1, -1, -1):
        out.append(int(lengths[j - 1]))
        j = int(choice[b, j])
    return out[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_words: int = 1024,
         buckets: int = 16, budget: int = 32_768, seed: int = 0) -> DataFrame:
    """One row per sequence: ``doc_id, row, piece, first_word, n_words,
    bucket_words, batch_id, place, padding``.

    ``bucket_words`` is the length that all sequences of the batch are padded
    to; a batch has at most ``budget`` words with padding (at least one
    sequence). Batch ids start with their bucket's number. Every word of every
    document is in exactly one sequence. Documents without words (null, empty
    or only white space) give no sequence; very long ones give many; repeated
    rows and ids are rows of their own. The order is that of a hash of the
    row, so equal rows stay together in no particular batch. An empty table
    gives no rows; other columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       word_count(F.col(text_col)).alias("size")).filter("size > 0")
    pieces = rows.select("row", "doc_id", "size", F.explode(F.expr(
        f"sequence(0L, (size - 1) div {max_words})")).alias("piece")).select(
        "row", "doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * max_words).alias("first_word"),
        F.least(F.lit(max_words), F.col("size") - F.col("piece") * max_words).cast("int").alias("n_words"))
    pieces = cut(pieces, "sequences")
    # At most max_words rows come to the driver, whatever the input.
    histogram = pieces.groupBy("n_words").count().orderBy("n_words").collect()
    ends = best_boundaries(np.array([r[0] for r in histogram]), np.array([r[1] for r in histogram]), buckets)
    bound = F.lit(ends[-1] if ends else 1)
    number = F.lit(max(len(ends) - 1, 0))
    for k in range(len(ends) - 2, -1, -1):
        bound = F.when(F.col("n_words") <= ends[k], F.lit(ends[k])).otherwise(bound)
        number = F.when(F.col("n_words") <= ends[k], F.lit(k)).otherwise(number)
    placed = pieces.withColumn("bucket_words", bound).withColumn("bucket", number).withColumn(
        "h", F.xxhash64(F.lit(seed), "doc_id", "piece", "row"))
    ranked = running_total(placed, "bucket", ["h", "row", "piece"], F.lit(1).cast("long"), "rank")
    room = F.greatest(F.floor(F.lit(budget) / F.col("bucket_words")), F.lit(1)).cast("long")
    return ranked.withColumn("room", room).select(
        "doc_id", "row", "piece", "first_word", "n_words", "bucket_words",
        F.concat_ws("-", F.lpad(F.col("bucket").cast("string"), 3, "0"),
                    F.lpad(F.expr("rank div room").cast("string"), 12, "0")).alias("batch_id"),
        F.expr("rank % room").cast("int").alias("place"),
        (F.col("bucket_words") - F.col("n_words")).alias("padding"))
