"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints are linked when at most RADIUS bits differ. For radius r, bit i
is given a vector m(i) of r + 1 bits; for each of the 2^(r+1) - 1 non-zero
vectors v, a table hashes a fingerprint by the bits with odd <m(i), v>. If two
fingerprints differ in at most r places, some v is orthogonal to the m(i) of
all of them, so both fall into one bucket of that table: no pair in the radius
is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import linked_components
from .common import arrow_batches, cut

SHINGLE, SEED, RADIUS = 4, 42, 4


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """One mask per table. The vectors m(i) run through all non-zero values in
    turn, so the tables keep about half of the bits each."""
    full = (1 << (radius + 1)) - 1
    m = [1 + (i * 11) % full for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (m[i] & v).bit_count() % 2) for v in range(1, full + 1)]


def shingle_hashes(text: bytes, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included; fewer words are
    hashed as one sequence; no words give nothing."""
    words = text.lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, seed)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[:len(words) - width] + 1).tolist()]
    ends = [*gaps[width - 1:].tolist(), len(joined)]
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], np.uint64)


def simhash(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes."""
    hashes = shingle_hashes(text, width, seed)
    if len(hashes) == 0:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint of each whole text as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash((t or "").encode()) for t in batch.column(1).to_pylist()],
                           np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(work, f"doc_id {kind}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Null and empty texts have no words: their fingerprint is zero, and zero is
    linked like any other. Texts are read whole, whatever their length.
    Repeated rows and ids have equal fingerprints, hence one component; a null
    id is never the smallest unless its component has no other. An empty table
    gives no rows. Other columns are not read.
    """
    with arrow_batches(docs.sparkSession, 500):
        prints = cut(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fps")
    tables = F.array(*[F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
                       for k, mask in enumerate(covering_masks(radius))])
    members = distinct.select("fp", F.explode(tables).alias("t")).select(
        "t.table", "t.key", F.col("fp").alias("node"))
    components = linked_components(members, radius)
    owner = cut(distinct.join(components.select(F.col("node").alias("fp"), "component"), "fp", "left")
                .withColumn("component", F.coalesce("component", "fp")), "fp_components")
    least = owner.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = cut(owner.join(least, "component").select("fp", "component_id"), "fp_labels")
    return prints.join(labels, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
