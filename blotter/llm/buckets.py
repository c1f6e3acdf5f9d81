"""Exact linking of the members of hash buckets, without all pairs.

``members(table, key, node)`` says which nodes fell into which bucket. Buckets
are walked in sorted order over range partitions, so one that holds a large
share of all rows spans many tasks. Inside a task, stretches of at most
STRETCH nodes of a bucket are compared in full and reported as links to the
smallest node of each linked set. Only a bucket that went on beyond one
stretch or one task needs more: once the links found so far are joined into
components, its nodes of different components are compared stretch by
stretch. A bucket whose nodes are all connected by then needs nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, cut, drop_tables, release_shuffles
from .graph import connected_components

STRETCH = 1024
STRETCH_BYTES = 1 << 20
#: Table and (nodes, payloads) twice -> matrix of linked pairs.
Near = Callable[[int, tuple[list, list], tuple[list, list]], np.ndarray]
#: Longest run of one bucket that a task holds at once.
HOLD = 64 * STRETCH


def _forest(near: np.ndarray) -> np.ndarray:
    """Smallest member of each node's set, for a boolean matrix of links."""
    label = np.arange(len(near))
    while True:
        least = np.where(near, label[None, :], len(near)).min(axis=1)
        least = np.minimum(label, least)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= radius


def _walk(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind, table, a, b) -> pa.RecordBatch:
            n = len(a)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind, np.int32)), pa.array(np.broadcast_to(np.int32(table), n)
                                                               if np.isscalar(table) else table, pa.int32()),
                 pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "table", "a", "b"])

        def finish(table, key, node, open_ends: bool) -> Iterator[pa.RecordBatch]:
            """A run of one bucket; open: it may go on in another task."""
            if len(node) == 1 and not open_ends:
                return
            for at in range(0, len(node), STRETCH):
                part = node[at:at + STRETCH]
                x = part.astype(np.uint64)
                label = _forest(_near(x, x, radius))
                moved = label != np.arange(len(part))
                if moved.any():
                    yield rows(0, int(table), part[moved], part[label[moved]])
            if open_ends or len(node) > STRETCH:
                yield rows(1, int(table), np.full(len(node), key), node)

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        first = True  # the run at hand is the first of this task
        flushed = None  # bucket of the last run that was not held to its end
        for batch in batches:
            t, k, v = (batch.column(i).to_numpy() for i in range(3))
            if held:
                t, k, v = (np.concatenate([*[h[i] for h in held], x]) for i, x in enumerate((t, k, v)))
                held = []
            new = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            edges = np.concatenate([[0], new, [len(t)]])
            sizes = np.diff(edges)
            # Runs of two are many: compare them in one step.
            inner = np.ones(len(sizes), bool)
            inner[-1] = False
            more = first or flushed == (t[0], k[0])  # the first run began earlier
            inner[0] &= not more
            two = edges[:-1][inner & (sizes == 2)]
            if len(two):
                close = np.bitwise_count(v[two].astype(np.uint64) ^ v[two + 1].astype(np.uint64)) <= radius
                if close.any():
                    yield rows(0, 0, v[two + 1][close], v[two][close])
            for i in np.flatnonzero((sizes > 2) | ~inner):
                s, e = edges[i], edges[i + 1]
                if i == len(sizes) - 1:  # it may go on in the next batch
                    if e - s < HOLD:
                        held = [(t[s:e], k[s:e], v[s:e])]
                    else:
                        yield from finish(t[s], k[s], v[s:e], True)
                        flushed = t[s], k[s]
                elif i == 0 and more:
                    yield from finish(t[s], k[s], v[s:e], True)
                else:
                    yield from finish(t[s], k[s], v[s:e], False)
            first = first and len(sizes) == 1
        if held:
            t, k, v = held[0]
            yield from finish(t[0], k[0], v, True)

    return work


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (table, key, component, node, payload) as one row per
    stretch: at most STRETCH nodes and, but for a single one, STRETCH_BYTES of
    payload."""
    for batch in batches:
        t, k, c, v = (batch.column(i).to_numpy() for i in range(4))
        payload = batch.column(4).to_pylist()
        edges, size = [0], 0
        for i in range(1, len(t)):
            size += len(payload[i - 1] or b"")
            if (t[i] != t[i - 1] or k[i] != k[i - 1] or i - edges[-1] >= STRETCH
                    or size + len(payload[i] or b"") > STRETCH_BYTES):
                edges.append(i)
                size = 0
        ends = [*edges[1:], len(t)]
        cols = [[int(t[s]) for s in edges], [int(k[s]) for s in edges], [int(v[s]) for s in edges],
                [int(c[s:e].min()) for s, e in zip(edges, ends)], [int(c[s:e].max()) for s, e in zip(edges, ends)],
                [v[s:e].tolist() for s, e in zip(edges, ends)], [c[s:e].tolist() for s, e in zip(edges, ends)],
                [payload[s:e] for s, e in zip(edges, ends)]]
        kinds = [pa.int32(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2, pa.list_(pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(cols, kinds)],
                                         ["table", "key", "id", "lo", "hi", "nodes", "comps", "payload"])


def _across(near: Near):
    """Compares pairs of stretches; the links of a whole task are joined into
    sets of components as they are found, so that it reports at most one link
    per component, and stretches that are already connected are skipped."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.setdefault(c, c) != c:
                root[c] = c = root[root[c]]
            return c

        for batch in batches:
            for table, an, ac, ap, bn, bc, bp in zip(*(batch.column(i).to_pylist() for i in range(7))):
                ra, rb = (np.array([find(c) for c in side], np.int64) for side in (ac, bc))
                apart = ra[:, None] != rb[None, :]
                if not apart.any():
                    continue
                i, j = np.nonzero(near(table, (an, ap), (bn, bp)) & apart)
                for x, y in set(zip(ra[i].tolist(), rb[j].tolist())):
                    x, y = find(x), find(y)
                    if x != y:
                        root[max(x, y)] = min(x, y)
        links = [(c, find(c)) for c in list(root)]
        links = [(c, r) for c, r in links if c != r]
        a, b = zip(*links) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return work


def within(radius: int) -> Near:
    """Nodes of which at most ``radius`` of 64 bits differ."""
    def near(table, a, b) -> np.ndarray:
        x, y = (np.array(nodes, np.int64).astype(np.uint64) for nodes, _ in (a, b))
        return _near(x, y, radius)

    return near


def linked_components(members: DataFrame, radius: int) -> DataFrame:
    """``(node, component)`` of every node with a link: nodes of one bucket are
    linked when at most ``radius`` of their 64 bits differ. Nodes are distinct
    fingerprints and not null; repeated rows add nothing; without rows there is
    no link and no row."""
    order = ["table", "key", "node"]
    walked = cut(members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
                 .mapInArrow(_walk(radius), "kind int, table int, a long, b long"), "walked")
    links = walked.filter("kind = 0").select("a", "b")
    first = connected_components(links)
    open_rows = walked.filter("kind = 1").select("table", F.col("a").alias("key"), F.col("b").alias("node"))
    return joined_buckets(open_rows, first, within(radius))


def joined_buckets(open_rows: DataFrame, first: DataFrame, near: Near,
                   payload: DataFrame | None = None) -> DataFrame:
    """Link what the buckets of ``open_rows(table, key, node)`` still have in
    different components of ``first(node, component)``. ``near`` gets a table and
    two lists of nodes with their payloads, if ``payload(node, payload)`` is
    given, and says which pairs are linked (it may leave out a pair that meets
    in an earlier table). Pairs exist inside a task only: it reports one
    link for two components. Repeated rows count once, nulls are not allowed; a
    bucket of any size is compared stretch by stretch; without rows, or without
    a bucket that spans components, the result is ``first``. Payloads stand here
    once per bucket of their node, so what holds them goes as soon as it was read."""
    spark = open_rows.sparkSession
    done: list[str] = []
    first = cut(first, "first_components")
    rows = cut(open_rows.distinct().join(first, "node", "left")
               .select("table", "key", F.coalesce("component", "node").alias("component"), "node"), "open_rows", done)
    mixed = rows.groupBy("table", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .filter("lo <> hi").select("table", "key")
    left = cut(rows.join(mixed, ["table", "key"], "left_semi"), "mixed_rows", done)
    if left.isEmpty():
        drop_tables(spark, done)
        return first
    left = left.join(payload, "node") if payload is not None else left.withColumn(
        "payload", F.lit(None).cast("binary"))
    order = ["table", "key", "component", "node"]
    kind = ("table int, key long, id long, lo long, hi long, nodes array<long>, comps array<long>, "
            "payload array<binary>")
    with arrow_batches(spark, 2 * STRETCH):
        parts = cut(left.select(*order, "payload").repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(_stretches, kind), "stretches", done)
    release_shuffles(spark)
    a, b = parts.alias("a"), parts.alias("b")
    pairs = a.join(b, (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key"))
                   & (F.struct("a.lo", "a.id") <= F.struct("b.lo", "b.id"))
                   & ~((F.col("a.lo") == F.col("b.hi")) & (F.col("a.hi") == F.col("b.lo"))))
    pairs = pairs.select("a.table", "a.nodes", "a.comps", "a.payload", F.col("b.nodes").alias("m"), F.col("b.comps").alias("n"),
                         F.col("b.payload").alias("p"))
    with arrow_batches(spark, 16):
        more = cut(pairs.mapInArrow(_across(near), "a long, b long").distinct(), "more_links")
    drop_tables(spark, done)
    release_shuffles(spark)
    merged = connected_components(more)
    top = merged.select(F.col("node").alias("component"), F.col("component").alias("top"))
    # Nodes without a first component are their own.
    alone = top.join(first.select(F.col("node").alias("component")), "component", "left_anti") \
        .select(F.col("component").alias("node"), F.col("top").alias("component"))
    return first.join(top, "component", "left").select(
        "node", F.coalesce("top", "component").alias("component")).unionByName(alone)
