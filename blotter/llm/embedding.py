"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors are made unit length and turned onto their principal axes, so that the
leading dimensions carry most of every product. Vectors with equal labels are
sorted by the first axis and cut into tiles; two tiles are compared only if
their boxes on the leading axes are near enough. Inside a comparison the
products of the leading dimensions come first, the rest is bounded by the
norms of the suffixes, and only pairs that can still reach the threshold get
the next dimensions. A pair that survives is checked on the original vectors.

Equal vectors are merged before and counted by their number. A comparison
reports per vector the number of its links and one link per linked set, never
all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, cut
from .graph import connected_components

THRESHOLD, TILE = 0.93, 512
#: Axes whose ranges are kept with a tile, and dimensions added per step.
BOX, STEP = 4, 8
#: Room for rounding in the bounds; the last check is exact.
ROOM = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, safe for extreme values."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _moments(dim: int):
    """One row per cell (i, j) of a task's sum of outer products."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = unit(_matrix(batch.column(0), dim))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], ["cell", "v"])

    return work


def principal_axes(valid: DataFrame, dim: int) -> np.ndarray:
    """Columns are the principal axes of all unit vectors, largest first. The
    sums over all rows meet in Spark; dim^2 numbers reach the driver."""
    cells = (valid.select("embedding").mapInArrow(_moments(dim), "cell long, v double")
             .groupBy("cell").agg(F.sum("v").alias("v")).collect())
    sums = np.zeros(dim * dim)
    for r in cells:
        sums[r["cell"]] = r["v"]
    _, axes = np.linalg.eigh(sums.reshape(dim, dim))
    return axes[:, ::-1]


def _first_axis(axes: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(_matrix(batch.column("embedding"), len(axes))) @ axes[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(x)], [*batch.schema.names, "first"])

    return work


def _tiles(axes: np.ndarray):
    """Sorted rows (label, node, copies, embedding) as one row per tile."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = len(axes)
        for batch in batches:
            label = batch.column("label").to_numpy()
            new = np.flatnonzero(label[1:] != label[:-1]) + 1
            for s, e in zip([0, *new], [*new, len(label)]):
                for at in range(s, e, TILE):
                    part = batch.slice(at, min(TILE, e - at))
                    x = _matrix(part.column("embedding"), dim)
                    lead = unit(x) @ axes[:, :BOX]
                    nodes = part.column("node").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(label[s])], pa.int64()), pa.array([int(nodes.min())]),
                         pa.array([lead.min(0).tolist()]), pa.array([lead.max(0).tolist()]),
                         pa.array([nodes.tolist()]), pa.array([part.column("copies").to_pylist()], pa.list_(pa.int64())),
                         pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())],
                        ["label", "tile", "lo", "hi", "nodes", "copies", "data"])

    return work


def survivors(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs whose product can reach ``threshold``; rows of ``a``
    and ``b`` are unit vectors on the principal axes."""
    dim = a.shape[1]
    rest_a = np.sqrt(np.maximum((a * a)[:, ::-1].cumsum(1)[:, ::-1], 0))
    rest_b = np.sqrt(np.maximum((b * b)[:, ::-1].cumsum(1)[:, ::-1], 0))
    at = min(STEP, dim)
    products = a[:, :at] @ b[:, :at].T
    bound = products + (np.outer(rest_a[:, at], rest_b[:, at]) if at < dim else 0)
    i, j = np.nonzero(bound >= threshold - ROOM)
    have = products[i, j]
    while at < dim and len(i):
        to = min(at + STEP, dim)
        have = have + np.einsum("ij,ij->i", a[i, at:to], b[j, at:to])
        rest = rest_a[i, to] * rest_b[j, to] if to < dim else 0.0
        keep = have + rest >= threshold - ROOM
        i, j, have, at = i[keep], j[keep], have[keep], to
    return i, j


def _compare(axes: np.ndarray, threshold: float):
    dim = len(axes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                left, right = (
                    [np.array(batch.column(k + c)[r].as_py()) for c in (0, 1)]
                    + [np.frombuffer(batch.column(k + 2)[r].as_py()).reshape(-1, dim)] for k in (0, 3))
                (na, ca, xa), (nb, cb, xb) = left, right
                same = na[0] == nb[0] and len(na) == len(nb) and (na == nb).all()
                ua, ub = unit(xa), unit(xb)
                i, j = survivors(ua @ axes, ub @ axes, threshold)
                if same:
                    i, j = i[i < j], j[i < j]
                cos = np.einsum("ij,ij->i", ua[i], ub[j])
                # Rounding cannot decide these: add their products exactly.
                for k in np.flatnonzero(np.abs(cos - threshold) < ROOM):
                    x, y = xa[i[k]], xb[j[k]]
                    cos[k] = math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))
                i, j = i[cos >= threshold], j[cos >= threshold]
                if len(i) == 0:
                    continue
                links: dict[int, int] = {}
                for nodes, other in ((na[i], cb[j]), (nb[j], ca[i])):
                    which, where = np.unique(nodes, return_inverse=True)
                    for n, s in zip(which.tolist(), np.bincount(where, other).astype(np.int64).tolist()):
                        links[n] = links.get(n, 0) + s
                # Join what is linked: every node points to a smaller one of its set.
                root = {n: n for n in links}

                def find(n: int) -> int:
                    while root[n] != n:
                        root[n] = n = root[root[n]]
                    return n

                for x, y in zip(na[i].tolist(), nb[j].tolist()):
                    x, y = find(x), find(y)
                    if x != y:
                        root[max(x, y)] = min(x, y)
                nodes = list(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64()),
                     pa.array([links[n] for n in nodes], pa.int64())], ["node", "to", "links"])

    return work


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors are compared only when their labels are equal and not null and
    their lengths agree; vectors that are null, empty or zero or hold null or
    non-finite components link with nothing. Repeated rows are vectors of their
    own and link with each other; where they share an id, each is kept if the
    id is its component's smallest. Vectors with a null id or label link with
    nothing. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    fine = (v.isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists(v, lambda x: x != 0.0))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.xxhash64(F.col(label_col)).alias("_l"),
                          F.col(label_col).alias("label_value"),
                          F.when(F.coalesce(fine, F.lit(False)), v).alias("embedding"))
    valid = rows.filter("embedding IS NOT NULL")
    # Equal vectors of one label: one node, counted by its copies.
    nodes = cut(valid.groupBy("label_value", "embedding").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()), "distinct_vectors")
    results = []
    for dim in sorted(r[0] for r in nodes.select(F.size("embedding")).distinct().collect()):
        one = nodes.filter(F.size("embedding") == dim).withColumn("label", F.xxhash64("label_value"))
        axes = principal_axes(one, dim)
        order = ["label", "first", "node"]
        inner = "label long, node long, copies long, embedding array<double>"
        with arrow_batches(spark, 4 * TILE):
            placed = cut(one.select("label", "node", "copies", "embedding").mapInArrow(
                _first_axis(axes), inner + ", first double"), "placed_vectors")
            tiles = cut(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
                _tiles(axes), "label long, tile long, lo array<double>, hi array<double>, nodes array<long>, "
                              "copies array<long>, data binary"), "tiles")
        box = tiles.select("label", "tile", "lo", "hi")
        a, b = box.alias("a"), box.alias("b")
        # Unit vectors with cosine c are sqrt(2 - 2c) apart.
        gaps = [F.greatest(F.element_at("a.lo", k + 1) - F.element_at("b.hi", k + 1),
                           F.element_at("b.lo", k + 1) - F.element_at("a.hi", k + 1), F.lit(0.0))
                for k in range(min(BOX, dim))]
        near = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= 2 - 2 * threshold + ROOM
        pairs = cut(a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.tile") <= F.col("b.tile")) & near)
                    .select(F.col("a.tile").alias("x"), F.col("b.tile").alias("y")), "tile_pairs")
        x = tiles.select(F.col("tile").alias("x"), F.col("nodes").alias("nx"), F.col("copies").alias("cx"),
                         F.col("data").alias("dx"))
        y = tiles.select(F.col("tile").alias("y"), F.col("nodes").alias("ny"), F.col("copies").alias("cy"),
                         F.col("data").alias("dy"))
        both = pairs.join(x, "x").join(y, "y").select("nx", "cx", "dx", "ny", "cy", "dy")
        with arrow_batches(spark, 16):
            results.append(cut(both.mapInArrow(_compare(axes, threshold), "node long, to long, links long"),
                               "tile_links"))
    if not results:
        found = spark.createDataFrame([], "node long, to long, links long")
    else:
        found = results[0]
        for more in results[1:]:
            found = found.unionByName(more)
    components = connected_components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    owner = cut(nodes.select("label_value", "embedding", "node", "least", "copies").join(sums, "node", "left")
                .join(components, "node", "left")
                .withColumn("component", F.coalesce("component", "node")), "vector_components")
    least = owner.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = cut(owner.join(least, "component").select(
        "label_value", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id"), "vector_labels")
    joined = rows.join(labelled, ["label_value", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
