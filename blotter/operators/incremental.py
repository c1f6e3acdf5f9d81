"""High-watermark increments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ts_literal(ts: dt.datetime | str) -> Column:
    """A ``timestamp_ntz`` literal from a datetime or ``YYYY-MM-DD HH:MM:SS`` text."""
    text = ts.isoformat(sep=" ") if isinstance(ts, dt.datetime) else str(ts)
    return F.lit(text).cast("timestamp_ntz")


def high_watermark(df: DataFrame | None, col: str):
    """``max(col)`` of a table as a driver-side scalar, ``None`` when the table
    is missing or empty. One aggregate; Parquet answers it from a narrow scan."""
    if df is None:
        return None
    return df.agg(F.max(col).alias("wm")).first()["wm"]


def since_watermark(df: DataFrame, ts_col: str, watermark) -> DataFrame:
    """Rows strictly newer than ``watermark``; all rows when it is ``None``.

    The literal reaches the Parquet scan as a pushed filter, so row groups whose
    max stamp is not newer are skipped.
    """
    if watermark is None:
        return df
    if isinstance(watermark, int):
        return df.filter(F.col(ts_col) > F.lit(watermark))
    return df.filter(F.col(ts_col) > ts_literal(watermark) if isinstance(
        watermark, (str, dt.datetime)) else F.col(ts_col) > F.lit(watermark))
