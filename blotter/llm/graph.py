"""Connected components of a graph given as pairs of longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component's
    id is its smallest node.

    Rounds of contraction: every vertex joins its smallest neighbour (or
    itself), edges are rewritten to the joined vertices, loops and repeats go.
    Vertices are renumbered by a one-to-one 64-bit mix first, so that chains of
    neighbouring numbers shrink by a constant factor each round. Each round is
    one partial aggregate and two joins whose inputs are written tables, which
    lets adaptive execution split a vertex with very many edges.

    Null ends, loops and repeated pairs are ignored; an empty input gives no
    rows.
    """
    # XXH64 of one long with a fixed seed only uses invertible steps, so two
    # nodes never mix to the same number.
    pairs = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.col("a").cast("long"), F.col("b").cast("long"))
    pairs = cut(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().select(
        "node", F.xxhash64("node").alias("x"))
    level = pairs.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    hooks: list[DataFrame] = []
    while not level.isEmpty():
        both = level.union(level.select("b", "a"))
        hook = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("x"), F.least("a", "m").alias("y")), "hooks")
        hooks.append(hook)
        to_a = hook.select(F.col("x").alias("a"), F.col("y").alias("ya"))
        to_b = hook.select(F.col("x").alias("b"), F.col("y").alias("yb"))
        level = cut(level.join(to_a, "a").join(to_b, "b").filter("ya <> yb").select(
            F.least("ya", "yb").alias("a"), F.greatest("ya", "yb").alias("b")).distinct(), "edges")
    if not hooks:
        return nodes.select("node", F.col("node").alias("component"))
    final = hooks[-1]
    for hook in reversed(hooks[:-1]):
        later = final.select(F.col("x").alias("y"), F.col("y").alias("z"))
        final = hook.join(later, "y", "left").select("x", F.coalesce("z", "y").alias("y"))
    labelled = cut(nodes.join(final, "x").select("node", F.col("y").alias("label")), "labels")
    smallest = cut(labelled.groupBy("label").agg(F.min("node").alias("component")), "smallest")
    return labelled.join(smallest, "label").select("node", "component")
