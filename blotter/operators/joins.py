"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.session import scratch_path

# Largest side that is ever broadcast: a row bound and a byte bound on the
# estimated in-memory size (rows x estimated row width), both must hold.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

# Estimated bytes per value by type (strings: a 32-character key).
_WIDTH = {T.IntegerType: 4, T.LongType: 8, T.DoubleType: 8, T.FloatType: 4, T.DateType: 4,
          T.TimestampType: 8, T.TimestampNTZType: 8, T.BooleanType: 1, T.ShortType: 2,
          T.ByteType: 1, T.StringType: 32}


def row_width(schema: T.StructType) -> int:
    """Estimated bytes per row (fixed-size types exactly, strings as 32 bytes,
    anything nested as 64) plus a per-row overhead."""
    return 16 + sum(_WIDTH.get(type(f.dataType), 64) for f in schema.fields)


def fits_broadcast(rows: int, schema: T.StructType, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return rows <= max_rows and rows * row_width(schema) <= max_bytes


def written(df: DataFrame, name: str = "written") -> DataFrame:
    """Write ``df`` to the shared scratch folder once; return the frame read
    back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str = "staged") -> tuple[DataFrame, int]:
    """``written`` and its row count. Plans that need a source's size and read
    it several times work on the staged copy, so the source itself runs once.
    The count comes from the written files' footers."""
    back = written(df, name)
    return back, back.count()


def bounded_broadcast(df: DataFrame, rows: int | None = None,
                      max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its row count is at most ``max_rows`` and its
    estimated size (rows x row width of the projected columns) at most
    ``max_bytes``.

    ``rows`` is a count known from the write that produced ``df`` (see
    ``TableStore``); without it ``df`` is staged and counted here. Beyond the
    bound the frame is returned unhinted and Spark shuffles (sort-merge join,
    AQE skew-splitting on).
    """
    if rows is None:
        df, rows = staged(df, "bounded")
    return F.broadcast(df) if fits_broadcast(rows, df.schema, max_rows, max_bytes) else df
