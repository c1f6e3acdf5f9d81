"""Code lists inside a row: build, clean and flatten them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def code_array(*cols: Column | str) -> Column:
    """Distinct non-null values of ``cols`` as one array (array(...) + compact)."""
    arr = F.array(*[F.col(c) if isinstance(c, str) else c for c in cols])
    return F.array_distinct(F.array_compact(arr))


def split_int_codes(text: Column | str) -> Column:
    """Space-separated code text to an array of distinct ints.

    Splits on runs of spaces, so doubled spaces give no empty token; tokens that
    are not integers are dropped (``try_cast``). ``'0416'`` becomes 416.
    """
    t = F.col(text) if isinstance(text, str) else text
    tokens = F.split(F.trim(t), " +")
    ints = F.transform(tokens, lambda x: x.try_cast("int"))
    return F.array_distinct(F.array_compact(ints))


def explode_codes(df: DataFrame, keys: list[str], array_col: Column, alias: str = "code") -> DataFrame:
    """One row per key and distinct non-null element; null/empty arrays give no row.

    A narrow, per-row operator (``Generate``): no shuffle.
    """
    return (df.select(*keys, F.explode(F.array_distinct(F.array_compact(array_col))).alias(alias)))
