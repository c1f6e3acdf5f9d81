"""Share-of-group percentages and spatial grid buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_half_up(part: Column | str, total: Column | str, digits: int = 2) -> Column:
    """``round(part * 100 / total, digits)`` with exact half-up rounding.

    Integer arithmetic, ``floor((2 * part * 100 * 10^d + total) / (2 * total)) / 10^d``,
    so exact halves never drift with floating point; the same as decimal
    rounding of the exact quotient. Result is a double.
    """
    scale = 10 ** digits
    p, t = _col(part).cast("long"), _col(total).cast("long")
    num = p * F.lit(2 * 100 * scale) + t
    den = t * F.lit(2)
    q = F.call_function("div", num, den)  # integer division: the floor of positive operands
    return F.when(t > 0, q.cast("double") / F.lit(float(scale)))


def grid_bucket(c: Column | str, digits: int = 3) -> Column:
    """Round a coordinate to ``digits`` decimals, half away from zero.

    Rounds the decimal value (``decimal(18,8)``), not the binary double, so a
    text coordinate like 34.0025 lands in 34.003 on every engine.
    """
    return F.round(_col(c).cast("decimal(18,8)"), digits).cast("double")


def share_of_group(df: DataFrame, by: list[str], partition: list[str],
                   count_col: str = "n", total_col: str = "total",
                   pct_col: str = "pct", digits: int = 2) -> DataFrame:
    """Count rows per ``by`` and each count's share of its ``partition`` total.

    The count is a partial+final hash aggregate; the window then runs over the
    aggregated rows only (one row per group), so its exchange is small.
    ``partition`` must be a subset of ``by``; nulls form their own group.
    """
    missing = [p for p in partition if p not in by]
    if missing:
        raise ValueError(f"partition columns {missing} are not grouping columns")
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_col))
    return share_of_counts(counted, partition, count_col, total_col, pct_col, digits)


def share_of_counts(counted: DataFrame, partition: list[str], count_col: str,
                    total_col: str, pct_col: str, digits: int = 2) -> DataFrame:
    """Add the partition total of ``count_col`` and the share as a percentage."""
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return (counted
            .withColumn(total_col, F.sum(count_col).over(w).cast("long"))
            .withColumn(pct_col, pct_half_up(count_col, total_col, digits)))
