"""Substring dedup by paragraph MinHash banding.

Units. A paragraph is a line of at least ``SHINGLE`` words, and also the words
of several lines up to a blank one, as a paragraph may be wrapped (a line of
fewer words has no shingle of its own). As a repeated passage need not start
or end with a line, passages of SPAN words are units as well: of any SPACING
neighbouring ones, the one with the smallest hash (winnowing). So every repeat
of SPAN + SPACING - 1 = 35 words, wherever it stands, holds an equal unit that
is long enough to be reported, and its span lacks at most SPACING - 1 words of
the repeat on a side. Where a text begins or ends, windows of fewer passages
count too, so repeats there reach to its first or last word.

Linking. Units with equal words are one class. Paragraph classes get MinHash
signatures over five-word shingles, cut into bands; classes that share a band
are candidates, and every candidate is verified by the exact Jaccard
similarity of its shingle sets. Components of the links are the clusters; the first unit of a cluster stays, the others are removals (but for
those that share words with the first one), and neighbouring units of a document are merged to spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .buckets import joined_buckets
from .common import arrow_batches, cut, drop_tables, release_shuffles, with_small_side
from .graph import connected_components

SHINGLE, SIMILARITY = 5, 0.8
#: Shortest merged span that is reported, in words; passages per choice of one.
SPAN, SPACING = 20, 16
#: Bytes of text handled at once inside a task.
PART = 1 << 21


def bands_for(similarity: float = SIMILARITY, recall: float = 0.998, rows: int = 3) -> int:
    """Bands of ``rows`` values so that a pair at ``similarity`` meets in one
    with probability ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity ** rows)))


ROWS = 3
BANDS = bands_for(rows=ROWS)
_rng = np.random.default_rng(20)
_A = _rng.integers(1, 2 ** 63, ROWS * BANDS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2 ** 63, ROWS * BANDS, dtype=np.uint64)
_C = _rng.integers(1, 2 ** 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def paragraphs(text: bytes, words: list[bytes]) -> Iterator[tuple[int, int]]:
    """Appends the words of a lower-cased text to ``words`` and gives the place
    of each paragraph there."""
    begin, lines = len(words), 0
    for line in [*text.split(b"\n"), b""]:
        at = len(words)
        words += line.split()
        if len(words) > at:
            lines += 1
            if len(words) - at >= SHINGLE:
                yield at, len(words)
        else:
            if lines > 1 and at - begin >= SHINGLE:
                yield begin, at
            begin, lines = at, 0


def _over(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every ``width`` neighbours; a power of two."""
    step = 1
    while step < width:
        x = best(x[:-step], x[step:])
        step *= 2
    return x


def winnow(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Starts of the chosen passages, for the hash of each word and the end of
    its text. Equal hashes are all chosen."""
    n = len(hashes) - SPAN + 1
    if n <= 0:
        return np.empty(0, np.int64)
    # Polynomial of SPAN words from running sums: the base is odd, so it can be divided by.
    powers = np.cumprod(np.full(n, pow(_BASE, -1, 2 ** 64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
        hashes * np.cumprod(np.full(len(hashes), _BASE, np.uint64)), dtype=np.uint64)])
    g = _mix(_mix((sums[SPAN:] - sums[:n]) * powers))
    top = np.uint64(2 ** 64 - 1)
    inside = np.arange(n) + SPAN <= last[:n]
    g[~inside] = top
    pad = np.full(SPACING - 1, top)
    least = _over(np.concatenate([pad, g, pad]), SPACING, np.minimum)
    return np.flatnonzero(inside & (g == _over(least, SPACING, np.maximum)))


class Units:
    """The units of a group of texts (lower-cased bytes)."""

    def __init__(self, texts: list[bytes]):
        words: list[bytes] = []
        places: list[tuple[int, int]] = []
        text_ends: list[int] = []
        for text in texts:
            places += paragraphs(text.lower(), words)
            text_ends.append(len(words))
        self.words = words
        n = len(words)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        sizes = np.fromiter(map(len, words), np.int64, n)
        joined = b" ".join(words)
        begin = np.concatenate([[0], np.cumsum(sizes + 1)])  # byte place of each word

        starts = np.concatenate([[0], text_ends[:-1]]).astype(np.int64)
        counts = np.array(text_ends, np.int64) - starts
        owner = np.repeat(np.arange(len(texts)), counts)
        first, last = starts[owner], (starts + counts)[owner]

        a = winnow(hashes, last)
        b = a + SPAN
        c, d = np.array(sorted(places), np.int64).reshape(-1, 2).T

        # In the order of the text, so that the first unit of a cluster stands
        # first in it too; a passage that is a paragraph is one unit.
        start, end = np.concatenate([c, a]), np.concatenate([d, b])
        _, once = np.unique(start * (n + 1) + end, return_index=True)
        self.start, self.end, self.is_paragraph = start[once], end[once], once < len(c)
        self.owner = owner[self.start] if n else np.empty(0, np.int64)
        self.first_word = self.start - (first[self.start] if n else 0)
        lo, hi = begin[self.start].tolist(), (begin[self.end] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        self.digest = np.array([digest(joined[x:y], 1) for x, y in zip(lo, hi)], np.uint64).astype(np.int64)
        self.bands = self._signatures(hashes, c, d)

    @staticmethod
    def _signatures(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(paragraphs, BANDS) keys; paragraphs may overlap."""
        if len(start) == 0:
            return np.empty((0, BANDS), np.int64)
        n = len(hashes) - SHINGLE + 1
        shingle = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            shingle += hashes[k:k + n] * _C[k]
        shingle = _mix(shingle)
        edges = np.stack([start, end - SHINGLE + 1], 1).ravel()  # places where shingles start
        top = np.array([2 ** 64 - 1], np.uint64)  # the last place may be n
        keys = np.empty((len(start), BANDS), np.uint64)
        for band in range(BANDS):
            key = np.full(len(start), band + 1, np.uint64)
            for r in range(ROWS):
                k = band * ROWS + r
                values = np.concatenate([_mix(shingle * _A[k] + _B[k]), top])
                least = np.minimum.reduceat(values, edges)[::2]
                key = _mix(key * _C[0] + least)
            keys[:, band] = key
        return keys.astype(np.int64)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text) + 64
        if size >= PART:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held


def find_units(docs: DataFrame) -> DataFrame:
    """All units of ``docs(row, doc_id, text)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            for at, group in _groups(texts):
                u = Units(group)
                take = pa.array(u.owner + at)
                # Copies of a paragraph share its bands: one of a group is enough.
                lines = np.flatnonzero(u.is_paragraph)
                once = np.zeros(len(lines), bool)
                once[np.unique(u.digest[lines], return_index=True)[1]] = True
                none = np.ones(len(u.digest), bool)
                none[lines[once]] = False
                keys = u.bands[once].ravel()
                counts = np.where(none, 0, BANDS)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(keys))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(take), batch.column("doc_id").take(take), pa.array(u.digest),
                     pa.array(u.first_word.astype(np.int32)), pa.array((u.end - u.start).astype(np.int32)), bands],
                    ["row", "doc_id", "digest", "first_word", "n_words", "bands"])

    return docs.select("row", "doc_id", "text").mapInArrow(
        work, f"row long, doc_id {kind}, digest long, first_word int, n_words int, bands array<long>")


def paragraph_words(docs: DataFrame) -> DataFrame:
    """``digest, words`` of every paragraph of ``docs(text)``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out: dict[int, bytes] = {}
                for text in batch.column(0).slice(at, 256).to_pylist():
                    words: list[bytes] = []
                    for s, e in list(paragraphs((text or "").encode().lower(), words)):
                        joined = b" ".join(words[s:e])
                        key = digest(joined, 1)
                        out[key - (1 << 64) if key >> 63 else key] = joined
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.binary())], ["digest", "words"])

    return docs.select("text").mapInArrow(work, "digest long, words binary")


def shingle_set(words: bytes) -> set[tuple[bytes, ...]]:
    w = words.split()
    return {tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))}


def _similar(similarity: float):
    """Candidate pairs (a, b, words of a, words of b) -> the similar ones."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            good = []
            last, left = None, set()
            for i in range(len(a)):
                if a[i] != last:
                    last, left = a[i], shingle_set(x[i])
                right = shingle_set(y[i])
                both = len(left & right)
                if both >= similarity * (len(left) + len(right) - both) - 1e-6:  # as in jaccard_near
                    good.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in good], pa.int64()),
                                              pa.array([b[i] for i in good], pa.int64())], ["a", "b"])

    return work


def jaccard_near(similarity: float, columns: int = 1 << 13):
    """Which of two lists of paragraphs are similar: the sizes of all shingle
    intersections are one matrix product, taken over ``columns`` shingles at a
    time so that it stays small however long the paragraphs are. A payload is
    a paragraph's band keys, then its words; a pair is looked at in the first
    band that it shares."""
    def near(table, a, b) -> np.ndarray:
        keys = [np.frombuffer(b"".join(p[:8 * BANDS] for p in side), ">i8").reshape(-1, BANDS) for _, side in (a, b)]
        todo = np.ones((len(keys[0]), len(keys[1])), bool)
        for band in range(table):
            todo &= keys[0][:, None, band] != keys[1][None, :, band]
        if not todo.any():
            return todo
        numbers: dict[tuple[bytes, ...], int] = {}
        sides = []
        for _, payload in (a, b):
            sets = [shingle_set(p[8 * BANDS:]) for p in payload]
            ids = np.array([numbers.setdefault(x, len(numbers)) for s in sets for x in s], np.int64)
            sizes = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(ids, kind="stable")
            sides.append((ids[order], owner[order], sizes))
        (ia, oa, na), (ib, ob, nb) = sides
        both = np.zeros((len(na), len(nb)), np.float32)
        for lo in range(0, len(numbers), columns):
            dense = []
            for ids, owner, sizes in sides:
                s, e = np.searchsorted(ids, [lo, lo + columns])
                m = np.zeros((len(sizes), min(columns, len(numbers) - lo)), np.float32)
                m[owner[s:e], ids[s:e] - lo] = 1
                dense.append(m)
            both += dense[0] @ dense[1].T
        return todo & (both >= similarity * (na[:, None] + nb[None, :] - both) - 1e-6)

    return near


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY, min_span: int = SPAN, across: bool = True,
                    own_words: int | None = None) -> DataFrame:
    """One row per repeated span: ``doc_id, row, first_word, n_words,
    component_id, n_units, kept``.

    ``first_word`` and ``n_words`` count words of the text; ``component_id`` is
    the smallest cluster in the span; ``kept`` spans are the first of their
    clusters, the others are removals. With ``across``, only clusters with
    units in two documents count, and with ``own_words`` also those of
    paragraphs of so many words in one document; without, all of a
    document's repeats of its own do as well. Documents without a repeated span of
    ``min_span`` words give no row, so null, empty and short texts have none;
    repeated rows repeat all of their spans; ids may be null; texts of any
    length are read whole. An empty table gives no rows, and other columns are
    ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    early: list[str] = []
    with arrow_batches(spark, 1000):
        units = cut(find_units(base).withColumn("unit", F.monotonically_increasing_id()), "units", early)
    # Nearly all passages occur once: only digests are counted here, and places
    # are brought together once it is known which classes are needed.
    repeats = cut(units.groupBy("digest").count().filter("count > 1").select("digest"), "repeats", early)
    release_shuffles(spark)

    # Candidates: every class with the smallest class of each of its bands. Both
    # uses of a band's classes read one exchange.
    done: list[str] = []
    members = units.filter(F.size("bands") > 0).select(
        F.col("digest").alias("node"), F.posexplode("bands").alias("table", "key")).repartition("table", "key")
    heads = members.groupBy("table", "key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")) \
        .filter("lo < hi").select("table", "key", "lo")
    meeting = cut(members.join(heads, ["table", "key"]).select("table", "key", "node", "lo").distinct(), "meeting", done)
    release_shuffles(spark)
    words = _words_of(base, _band_keys(meeting), done)
    release_shuffles(spark)
    pairs = meeting.filter("node <> lo").select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct()
    x = words.select(F.col("digest").alias("a"), F.col("words").alias("x"))
    y = words.select(F.col("digest").alias("b"), F.col("words").alias("y"))
    with arrow_batches(spark, 2000):
        links = cut(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
                    .mapInArrow(_similar(similarity), "a long, b long"), "similar", done)
    release_shuffles(spark)
    # Then what a bucket still holds in different components, all against all:
    # but for its smallest class, which has been compared with every other one,
    # so the many buckets of two need no second look.
    clusters = cut(joined_buckets(meeting.filter("node <> lo").select("table", "key", "node"),
                                  connected_components(links), jaccard_near(similarity),
                                  words.select(F.col("digest").alias("node"),
                                               F.concat("keys", "words").alias("payload"))), "clusters")
    drop_tables(spark, done)
    release_shuffles(spark)

    wanted = cut(repeats.join(clusters.withColumnRenamed("node", "digest"), "digest", "full_outer")
                 .withColumn("component", F.coalesce("component", "digest")), "wanted_classes")
    own = F.lit(False) if own_words is None else (F.size("bands") > 0) & (F.col("n_words") >= own_words)
    places = cut(units.select("unit", "row", "doc_id", "digest", "first_word", "n_words", own.alias("own"))
                 .join(wanted, "digest").drop("digest"), "places")
    drop_tables(spark, early)
    release_shuffles(spark)
    keepers = places.groupBy("component").agg(
        F.min(F.struct("unit", "row", "first_word", "n_words")).alias("keep"), F.max("row").alias("hi"),
        F.max("own").alias("own")).withColumn("wide", F.expr("keep.row < hi"))
    if across:
        keepers = keepers.filter("wide OR own")
    keepers = cut(keepers.select("component", "keep", "wide"), "keepers")
    release_shuffles(spark)
    # A paragraph and its longest line may be similar: what shares words with
    # the first unit is no second copy of it.
    copies = F.expr("unit = keep.unit OR NOT (row = keep.row AND first_word < keep.first_word + keep.n_words"
                    " AND first_word + n_words > keep.first_word)")
    kept = F.expr("unit = keep.unit")
    places = places.drop("own")
    repeated = places.join(keepers.filter("wide"), "component").filter(copies).withColumn("kept", kept)
    if own_words is not None or not across:
        alone = cut(places.join(keepers.filter("NOT wide"), "component").filter(copies).withColumn("kept", kept),
                    "one_document")
        removed = alone.filter("NOT kept").select("component").distinct()
        repeated = repeated.unionByName(alone.join(removed, "component", "left_semi"))

    # Merge touching units of a document.
    end = F.col("first_word") + F.col("n_words")
    order = Window.partitionBy("row", "kept").orderBy("first_word", "n_words", "unit")
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = repeated.withColumn("new", F.coalesce(F.col("first_word") > reach, F.lit(True)).cast("int")).withColumn(
        "island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = islands.groupBy("row", "kept", "island").agg(
        F.min("doc_id").alias("doc_id"), F.min("first_word").alias("first_word"), F.max(end).alias("end"),
        F.min("component").alias("component_id"), F.count("*").alias("n_units"))
    return spans.select("doc_id", "row", "first_word", (F.col("end") - F.col("first_word")).alias("n_words"),
                        "component_id", "n_units", "kept").filter(F.col("n_words") >= min_span)


def _band_keys(meeting: DataFrame) -> DataFrame:
    """``digest, keys``: the band keys of each node in order, eight bytes each.
    A band in which a node meets no other gets a value of its own."""
    bands = [F.max(F.when(F.col("table") == k, F.col("key"))).alias(f"k{k}") for k in range(BANDS)]
    rows = meeting.groupBy(F.col("node").alias("digest")).agg(*bands)
    keys = [F.unhex(F.lpad(F.hex(F.coalesce(f"k{k}", F.xxhash64("digest", F.lit(k)))), 16, "0")) for k in range(BANDS)]
    return rows.select("digest", F.concat(*keys).alias("keys"))


def _words_of(base: DataFrame, wanted: DataFrame, done: list[str]) -> DataFrame:
    """``digest, words, keys`` of the paragraphs of ``wanted(digest, keys)``."""
    wanted = cut(wanted, "wanted", done)
    with arrow_batches(base.sparkSession, 1000):
        return cut(paragraph_words(base.select("text")).join(with_small_side(wanted), "digest")
                   .dropDuplicates(["digest"]), "paragraph_words", done)
