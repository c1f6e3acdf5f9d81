"""Merkle manifest of a dataset, and proofs by descent of its DAG.

Leaves are hashed rows; inside a tree (one per source) each run of three nodes
is hashed to its parent until one node is left, and the trees' roots are the
leaves of a top tree. What is stored are records ``digest -> children``. They
are written in segments of ``LEVELS`` levels (at most 3^LEVELS leaves each): a
task builds a whole segment, and a segment is what a task needs to answer any
request inside it.

A request for a leaf starts at the root digest. Its rank, written in base
three, says which child to take at each level: the record of the current
digest is looked up, the children not taken are collected as one path segment,
and the descent goes on with the digest of the child taken. The proof is the
list of path segments in reverse, from leaf to root. Requests that share a
segment share its descent from above, so a request for every row costs one
shuffle of the rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.position import with_position

from .common import bounded_side, cut

ARITY = 3
#: Levels of a segment: at most 3^7 = 2,187 leaves and 1,093 records.
LEVELS = 7
WIDTH = ARITY ** LEVELS
SIZE = 32
_RECORD = "tree string, segment long, left int, node binary, children binary, is_root boolean"


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    """Digest (32 bytes) of a row's values."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def tree_name(source: Column) -> Column:
    """A name that is never null and sorts null sources first."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def _height(n: Column) -> Column:
    """Levels above the leaves: the smallest h with 3^h >= n."""
    return F.size(F.filter(F.array(*[F.lit(ARITY ** h).cast("long") for h in range(40)]), lambda p: p < n))


def parent(children: bytes) -> bytes:
    """Digest of the children's digests, taken as hex text."""
    return hashlib.sha256(children.hex().encode()).digest()


@dataclass
class Forest:
    """Trees over ranked leaves: ``trees(tree, n, height, root)`` and, per
    round of ``LEVELS`` levels, the records of its segments."""
    trees: DataFrame
    rounds: list[DataFrame]


@dataclass
class Manifest:
    """``leaves(tree, rank, node, ...)``, the trees over them, the top tree over
    the trees' roots, and each tree's place in it."""
    leaves: DataFrame
    forest: Forest
    top: Forest
    places: DataFrame


def _build_segment(pdf: pd.DataFrame) -> pd.DataFrame:
    tree, segment, left = pdf["tree"].iloc[0], int(pdf["segment"].iloc[0]), int(pdf["left"].iloc[0])
    level = [bytes(x) for x in pdf.sort_values("idx")["node"]]
    records: list[tuple[bytes, bytes | None]] = []
    for _ in range(min(LEVELS, left)):
        runs = [b"".join(level[i:i + ARITY]) for i in range(0, len(level), ARITY)]
        level = [parent(run) for run in runs]
        records += zip(level, runs)
    root = level[0]
    if not records:  # a tree of one leaf
        records = [(root, None)]
    nodes, children = zip(*records)
    return pd.DataFrame({"tree": tree, "segment": segment, "left": left, "node": nodes, "children": children,
                         "is_root": [i == len(nodes) - 1 for i in range(len(nodes))]})


def grow(leaves: DataFrame, trees: DataFrame, name: str) -> Forest:
    """All trees over ``leaves(tree, rank, node)``; ``trees(tree, n, height)``.

    Each round turns every segment of 3^LEVELS neighbours into its records and
    one node; trees that are then down to one node are done."""
    most = trees.agg(F.max("height")).first()[0] or 0
    nodes = leaves.join(bounded_side(trees.select("tree", "height")), "tree").select(
        "tree", F.col("height").alias("left"), F.col("rank").alias("idx"), "node")
    rounds, roots = [], []
    for at in range(max(1, -(-most // LEVELS))):
        grouped = nodes.withColumn("segment", F.expr(f"idx div {WIDTH}")).groupBy("tree", "segment")
        records = cut(grouped.applyInPandas(_build_segment, _RECORD), f"{name}_records_{at}")
        rounds.append(records)
        above = records.filter("is_root")
        roots.append(above.filter(F.col("left") <= LEVELS).select("tree", F.col("node").alias("root")))
        nodes = above.filter(F.col("left") > LEVELS).select(
            "tree", (F.col("left") - LEVELS).alias("left"), F.col("segment").alias("idx"), "node")
    return Forest(cut(trees.join(reduce(DataFrame.unionByName, roots), "tree"), f"{name}_trees"), rounds)


def build_manifest(docs: DataFrame, values: list[str], id_col: str = "doc_id", source_col: str = "source",
                   payload: dict[str, Column] | None = None) -> Manifest:
    """Manifest of ``docs``: a leaf per row over ``values``, ranked by id inside
    its source.

    ``payload`` are more columns, computed beside the leaf and carried along.
    A null source is a tree of its own, the first one. Null ids come first in
    their tree; rows with equal ids are ranked by their digest, and equal rows
    are leaves of their own. Very long texts are only hashed. Columns not named
    are not read. An empty table has no leaves, no trees and no root."""
    extra = payload or {}
    rows = docs.select(tree_name(F.col(source_col)).alias("tree"), F.col(id_col).alias("id"),
                       leaf_digest([F.col(v) for v in values]).alias("node"), *[c.alias(k) for k, c in extra.items()])
    placed = with_position(rows, [F.col("tree"), F.col("id").asc_nulls_first(), F.col("node")])
    trees = cut(placed.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("start"))
                .withColumn("height", _height(F.col("n"))), "merkle_trees")
    leaves = placed.join(bounded_side(trees.select("tree", "start")), "tree").select(
        "tree", (F.col("position") - F.col("start")).alias("rank"), "node", "id", *extra)
    forest = grow(leaves, trees.drop("start"), "merkle")
    places = cut(with_position(forest.trees.select("tree", F.col("root").alias("node")), [F.col("tree")], "rank"),
                 "merkle_places")
    over = places.groupBy(F.lit("").alias("tree")).agg(F.count(F.lit(1)).alias("n"))
    top = grow(places.select(F.lit("").alias("tree"), "rank", "node"), over.withColumn("height", _height(F.col("n"))),
               "merkle_top")
    return Manifest(leaves, forest, top, places)


def _descend(requests: DataFrame, records: DataFrame, starts: DataFrame) -> DataFrame:
    """Requests ``(tree, idx, ...)`` followed through one round of segments.
    ``starts(tree, segment, at, proof, steps)`` says with which digest a
    segment is entered and the path above it. Adds ``at`` (the digest reached),
    ``proof`` (digests not taken, leaf to root) and ``steps`` (a byte per level:
    place in the run times four plus length of the run)."""
    payload = [c for c in requests.columns if c not in ("tree", "idx")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in requests.schema.fields)

    def follow(store: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = {c: wanted[c] for c in ["tree", "idx", *payload]}
        entry = store[store["proof"].notna()]
        if not len(wanted) or not len(entry):
            return pd.DataFrame({**{c: v[:0] for c, v in out.items()}, "at": [], "proof": [], "steps": []})
        root, above, steps_above = (bytes(entry[c].iloc[0]) for c in ("node", "proof", "steps"))
        known = store[store["children"].notna()]
        children = {bytes(n): bytes(c) for n, c in zip(known["node"], known["children"])}
        levels = store["left"].dropna()
        height = min(LEVELS, int(levels.iloc[0])) if len(levels) else 0
        ats, proofs, steps = [], [], []
        for idx in wanted["idx"]:
            at, segments, turns = root, [], []
            for level in range(height - 1, -1, -1):
                run = children[at]
                digit = idx // ARITY ** level % ARITY
                here = digit * SIZE
                at = run[here:here + SIZE]
                segments.append(run[:here] + run[here + SIZE:])
                turns.append(digit * 4 + len(run) // SIZE)
            ats.append(at)
            proofs.append(b"".join(reversed(segments)) + above)
            steps.append(bytes(reversed(turns)) + steps_above)
        return pd.DataFrame({**out, "at": ats, "proof": proofs, "steps": steps})

    none = lambda kind: F.lit(None).cast(kind)
    store = records.select("tree", "segment", "left", "node", "children", none("binary").alias("proof"),
                           none("binary").alias("steps")).unionByName(
        starts.select("tree", "segment", none("int").alias("left"), F.col("at").alias("node"),
                      none("binary").alias("children"), "proof", "steps"))
    segment = F.expr(f"idx div {WIDTH}")
    return (store.groupBy("tree", "segment")
            .cogroup(requests.withColumn("segment", segment).groupBy("tree", "segment"))
            .applyInPandas(follow, schema + ", at binary, proof binary, steps binary"))


def descend(forest: Forest, requests: DataFrame, entries: DataFrame, name: str) -> DataFrame:
    """Requests ``(tree, idx, ...)`` from the roots of their trees down to the
    leaves. ``entries(tree, at, proof, steps)``: each tree's root and the path
    above it."""
    entries = entries.join(bounded_side(forest.trees.select("tree", "height")), "tree")
    starts = None
    for at in range(len(forest.rounds) - 1, -1, -1):
        # Trees whose root lies in this round are entered here, at segment 0.
        low, high = at * LEVELS, (at + 1) * LEVELS
        own = (F.col("height") <= high) & ((F.col("height") > low) | F.lit(at == 0))
        here = entries.filter(own).select("tree", F.lit(0).cast("long").alias("segment"), "at", "proof", "steps")
        starts = here if starts is None else starts.unionByName(here)
        if at == 0:
            return _descend(requests, forest.rounds[0], starts)
        wanted = (requests.join(bounded_side(forest.trees.filter(F.col("height") > low).select("tree")), "tree",
                                "left_semi").select("tree", F.expr(f"idx div {ARITY ** low}").alias("idx")).distinct())
        found = _descend(wanted, forest.rounds[at], starts)
        starts = cut(found.select("tree", F.col("idx").alias("segment"), "at", "proof", "steps"), f"{name}_{at}")


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Proofs for the leaves ``requests(tree, rank, ...)`` by descent from the
    root: the requested rows (other columns kept) with ``at`` (the leaf digest
    the descent arrives at), ``proof``, ``steps``, ``subroot`` and ``root``.

    Each request is one leaf; repeated requests are answered each. A request for
    a rank that its tree does not have fails the job."""
    places = manifest.places.select(F.lit("").alias("tree"), F.col("rank").alias("idx"), F.col("tree").alias("name"))
    root = manifest.top.trees.select("root").first()  # one value; none if there is no leaf
    empty = F.lit(b"").cast("binary")
    top = manifest.top.trees.select("tree", F.col("root").alias("at"), empty.alias("proof"), empty.alias("steps"))
    entries = cut(descend(manifest.top, places, top, "merkle_top_paths").select(
        F.col("name").alias("tree"), "at", "proof", "steps"), "merkle_entries")
    found = descend(manifest.forest, requests.withColumnRenamed("rank", "idx"), entries, "merkle_paths")
    sub = manifest.forest.trees.select("tree", F.col("root").alias("subroot"))
    return (found.withColumnRenamed("idx", "rank").join(bounded_side(sub), "tree")
            .withColumn("root", F.lit(root and bytes(root[0])).cast("binary")))


def fold(leaf: pd.Series, proof: pd.Series, steps: pd.Series) -> pd.Series:
    """The root that a leaf digest, its proof and its steps give."""
    out = []
    for node, siblings, turns in zip(leaf, proof, steps):
        node, siblings, used = bytes(node), bytes(siblings), 0
        for turn in bytes(turns):
            place, run = turn // 4 * SIZE, (turn % 4 - 1) * SIZE
            others = siblings[used:used + run]
            node, used = parent(others[:place] + node + others[place:]), used + run
        out.append(node)
    return pd.Series(out)


def folded_root(leaf: Column, proof: Column, steps: Column) -> Column:
    return F.pandas_udf(fold, "binary")(leaf, proof, steps)
