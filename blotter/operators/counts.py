"""Stored counts kept up to date by signed changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.joins import fits_broadcast


def signed(before: DataFrame, after: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Change of counts from ``before`` to ``after``: one row per key whose
    count differs, with the difference in ``count``."""
    both = before.select(*keys, (-F.col(count)).alias(count)).unionByName(after.select(*keys, count))
    return both.groupBy(*keys).agg(F.sum(count).cast("long").alias(count)).filter(F.col(count) != 0)


def add_counts(state: DataFrame, delta: DataFrame, keys: list[str], delta_rows: int, count: str = "n") -> DataFrame:
    """``state`` with ``delta`` added per key (null keys are equal); keys whose
    count becomes zero go.

    A delta within the broadcast bounds is added to the streamed state, and only
    keys that the state does not have yet are looked for: the state is not
    shuffled. A larger one is summed with it."""
    if not fits_broadcast(delta_rows, delta.schema):
        both = state.select(*keys, count).unionByName(delta.select(*keys, count))
        return both.groupBy(*keys).agg(F.sum(count).cast("long").alias(count)).filter(F.col(count) != 0)

    d = F.broadcast(delta.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(count).alias("__change")))
    same: Column = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    kept = (state.join(d, same, "left")
            .select(*keys, (F.col(count) + F.coalesce("__change", F.lit(0))).cast("long").alias(count)))
    had = state.select(*keys).join(d, same, "left_semi").select(*[F.col(k).alias(f"__{k}") for k in keys])
    new = delta.join(F.broadcast(had), same, "left_anti").select(*keys, count)
    return kept.unionByName(new).filter(F.col(count) != 0)
