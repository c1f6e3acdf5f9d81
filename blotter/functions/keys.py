"""Hashed surrogate keys.

A key is the MD5 of the column texts joined by ``-``, with a fixed token in
place of a null, so null and the empty string get different keys. Built from
business keys only: every executor computes it locally, with no lookup table
and no sequence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null stand-in and the separator of the key text.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"

# Doubles are keyed through a fixed decimal text, never Spark's own double
# text (which switches to 1.0E7 / 1.0E-4 notation).
DOUBLE_KEY_TYPE = "decimal(18,8)"


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double_text(c: Column | str) -> Column:
    """Key text of a double: its value as ``decimal(18,8)``."""
    return _as_column(c).cast(DOUBLE_KEY_TYPE).cast("string")


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 key over ``cols`` in order. Never null."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [F.coalesce(_as_column(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
