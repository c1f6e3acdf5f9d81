"""Calendar helpers: date spine, day-part buckets and text time parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Day parts by hour, inclusive bounds.
PARTS_OF_DAY = [(0, 5, "Night"), (6, 11, "Morning"), (12, 17, "Afternoon"), (18, 23, "Evening")]
UNKNOWN_PART = "Unknown"

# Text format of the incident dates.
INCIDENT_DATE_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def _as_date(d: dt.date | str) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)[:10])


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str,
               num_partitions: int | None = None) -> DataFrame:
    """One row per day in ``[start, end)`` as column ``date_day``.

    Generated by ``spark.range`` so long spines are split over tasks like any
    other range; empty when ``start >= end``.
    """
    start_d, end_d = _as_date(start), _as_date(end)
    n = max((end_d - start_d).days, 0)
    ids = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(0, n)
    return ids.select(F.date_add(F.lit(start_d), F.col("id").cast("int")).alias("date_day"))


def part_of_day(hour: Column | str) -> Column:
    h = F.col(hour) if isinstance(hour, str) else hour
    expr = None
    for lo, hi, label in PARTS_OF_DAY:
        cond = h.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(UNKNOWN_PART)


def parse_incident_date(text: Column | str) -> Column:
    """``MM/dd/yyyy hh:mm:ss AM`` text to a date; malformed text fails the job."""
    t = F.col(text) if isinstance(text, str) else text
    return F.to_date(t, INCIDENT_DATE_FORMAT)


def hhmm_parts(text: Column | str) -> tuple[Column, Column]:
    """Unpadded ``HHmm`` text to (hour, minute) ints.

    Left-pads to four digits; an hour above 23 or a minute above 59 raises, as
    a time parse would.
    """
    t = F.col(text) if isinstance(text, str) else text
    padded = F.lpad(t.cast("string"), 4, "0")
    hour = F.substring(padded, 1, 2).cast("int")
    minute = F.substring(padded, 3, 2).cast("int")
    bad = (hour > 23) | (minute > 59) | (hour < 0) | (minute < 0)
    err = F.raise_error(F.concat(F.lit("invalid time of day: "), t.cast("string")))
    hour = F.when(t.isNull(), F.lit(None).cast("int")).when(bad, err.cast("int")).otherwise(hour)
    return hour, minute
