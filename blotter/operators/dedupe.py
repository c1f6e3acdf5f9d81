"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per ``keys`` (null keys group together): the row with the
    greatest ``order_cols``; ties go to the greatest remaining columns, so the
    result is deterministic.

    The greatest first order column per key is a hash aggregate (combined on
    the map side, so a hot key sends one row per task); only rows that have it
    are ranked, and the ranking keeps one row per key and task before its
    exchange.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    top = df.groupBy(*keys).agg(F.max(order_cols[0]).alias("__top")).select(
        *[F.col(k).alias(f"__{k}") for k in keys], "__top")
    on = F.col(order_cols[0]).eqNullSafe(F.col("__top"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    near = df.join(top, on, "left_semi")
    return _first_of(near, keys, order_cols[1:] + rest)


def latest_label(df: DataFrame, key: str, label: str, stamp: str) -> DataFrame:
    """``key, label, stamp``: the label of the greatest stamp per key (then the
    greatest label). Rows are first reduced by a hash aggregate to one per key
    and label, so only that small result is ranked."""
    seen = df.groupBy(key, label).agg(F.max(stamp).alias(stamp))
    return _first_of(seen, [key], [stamp, label])


def _first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row that comes first by descending ``order`` (nulls last)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order] or [F.lit(1)])
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")
