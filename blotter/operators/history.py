"""The change history of a whole feed in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.operators.merge import rows_differ
from blotter.operators.snapshot import VALID_FROM, VALID_TO


def feed_history(feed: DataFrame, keys: list[str], check_cols: list[str], stamp: str) -> DataFrame:
    """Versions that loading ``feed`` stamp by stamp into a type-2 snapshot
    leaves: ``keys, check_cols, valid_from, valid_to``.

    Gaps and islands: a row opens a version when its key's previous row differs
    in a check column (null-safely), and is closed by the next such row. Both
    windows share one exchange and one sort by key and stamp. One key's rows
    (one per load it came with) are sorted by one task. ``feed`` holds one row
    per key and stamp; a key that a load does not bring stays as it is."""
    w = Window.partitionBy(*keys).orderBy(stamp)
    before = [(F.col(c), F.lag(c).over(w)) for c in check_cols]
    opens = F.lag(F.lit(1)).over(w).isNull() | rows_differ(before)
    rows = feed.select(*keys, *check_cols, F.col(stamp)).withColumn("__opens", opens).filter("__opens")
    return rows.withColumn(VALID_TO, F.lead(stamp).over(w)).withColumnRenamed(stamp, VALID_FROM).select(
        *keys, *check_cols, VALID_FROM, VALID_TO)


def feed_seen(feed: DataFrame, keys: list[str], stamp: str, doe_col: str = "doe", dlu_col: str = "dlu") -> DataFrame:
    """First and last load of each key of a feed: one partial aggregate, so a
    key of any number of rows reaches the shuffle once per task."""
    return feed.groupBy(*keys).agg(F.min(stamp).alias(doe_col), F.max(stamp).alias(dlu_col))
