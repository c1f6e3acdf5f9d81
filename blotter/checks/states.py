"""Monitors from stored partial states.

A monitor's input is one row per day and column; what a day's row is made of
can be merged: counts, sums, sums of squares, least and greatest values, and
the distinct update stamps. So these are kept per partition of a live table.
After a load, the states of the partitions that the load has replaced are made
anew (it reads no other file) and all others stay, also when reports were
changed or moved to another day. Merging a table's states then gives what a scan
of the whole table gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.checks import monitors as M
from blotter.plans.staging import stg_incidents
from blotter.sources.store import PART

STATE = "mart_state"
DAYS, STAMPS = "raw_incident_days", "fct_incident_stamps"
# The columns monitored per day of occurrence.
DAY_COLUMNS = ["vict_age"]


def day_states(df: DataFrame, ts_col: str, cols: list[str], by: list[str] = ()) -> DataFrame:
    """``by, bucket, column, n, nulls, zeros, total, squares, lo, hi``: one
    partial aggregate over ``df``. Rows without a stamp have the null bucket."""
    parts = []
    for c in cols:
        v = F.col(c).cast("double")
        parts.append(F.struct(F.lit(c).alias("column"), v.alias("v")))
    long = df.select(*by, F.to_date(F.col(ts_col)).alias("bucket"), F.explode(F.array(*parts)).alias("p")).select(
        *by, "bucket", "p.column", "p.v")
    v = F.col("v")
    return long.groupBy(*by, "bucket", "column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(v.isNull().cast("long")).alias("nulls"),
        F.sum((v == 0).cast("long")).alias("zeros"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"),
        F.min(v).alias("lo"), F.max(v).alias("hi"))


def merged_states(states: DataFrame) -> DataFrame:
    """States of the same day and column (of partitions, loads, tables) as one."""
    total = lambda c: F.sum(c).alias(c)
    return states.groupBy("bucket", "column").agg(
        total("n"), total("nulls"), total("zeros"), total("total"), total("squares"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def volume_series(states: DataFrame, column: str) -> DataFrame:
    return M.every_day(merged_states(states).filter((F.col("column") == column) & F.col("bucket").isNotNull())
                       .select("bucket", F.col("n").alias("value")))


def metric_series(states: DataFrame, column: str) -> DataFrame:
    """``(bucket, metric, value)`` as ``monitors.column_metrics`` makes them."""
    known = F.col("n") - F.coalesce("nulls", F.lit(0))
    nulls = F.coalesce("nulls", F.lit(0)).cast("double")
    spread = F.greatest(F.col("squares") - F.col("total") * F.col("total") / known, F.lit(0.0))
    per_day = merged_states(states).filter(F.col("column") == column).select(
        "bucket", nulls.alias("null_count"), (nulls * 100.0 / F.col("n")).alias("null_percent"),
        F.col("lo").alias("min"), F.col("hi").alias("max"),
        F.when(known > 0, F.col("total") / known).alias("average"),
        F.when(known > 1, F.sqrt(spread / (known - 1))).alias("standard_deviation"),
        F.coalesce("zeros", F.lit(0)).cast("double").alias("zero_count"))
    return M.per_metric(per_day)


def advance_state(store, name: str, schema: str, table: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Bring the state table ``name`` up to the live table it is kept for.
    ``make`` turns rows with the partition column into states with it. Only
    partitions replaced since the state's own mark are read; all of them when
    there is no state yet or the table's history does not reach back."""
    upto, known = store.watermark(schema, table), store.meta(STATE, name)
    if known is not None and known["watermark"] == upto:
        return store.read(STATE, name)
    rows = store.read_live(schema, table)
    parts = None if known is None else store.parts_since(schema, table, known["watermark"])
    if parts is None:
        return store.write(make(rows), STATE, name, watermark=upto)
    fresh = make(rows.filter(F.col(PART).isin(parts)))
    kept = store.read(STATE, name).filter(~F.col(PART).isin(parts))
    return store.write(kept.unionByName(fresh), STATE, name, watermark=upto)


def incident_days(store) -> DataFrame:
    """States of the raw incidents per day of occurrence."""
    def make(rows: DataFrame) -> DataFrame:
        # Every column of staging stands for one of the raw table; the
        # partition is that of the report number.
        stg = stg_incidents(rows).select("dr_no", "date_occ", *DAY_COLUMNS)
        part = store.part_of("raw", "raw_incidents")
        return day_states(stg.withColumn(PART, part), "date_occ", DAY_COLUMNS, [PART])

    return advance_state(store, DAYS, "raw", "raw_incidents", make)


def fact_stamps(store) -> DataFrame:
    """Distinct update stamps of the fact."""
    return advance_state(store, STAMPS, "mart_core", "fct_incidents",
                         lambda rows: rows.select(PART, "dlu").distinct())


def incident_findings(states: DataFrame) -> DataFrame:
    """Volume and column monitors of the incidents per day of occurrence:
    ``(monitor, column, bucket, value, z_score, is_anomaly)``."""
    parts = []
    for c in DAY_COLUMNS:
        found = M.metric_anomalies(metric_series(states, c))
        parts.append(found.select(F.lit("column").alias("monitor"), F.concat(F.lit(c + ":"), F.col("metric")).alias("column"),
                                  "bucket", F.col("value").cast("double").alias("value"), "z_score", "is_anomaly"))
    volume = M.z_score_anomalies(volume_series(states, DAY_COLUMNS[0]))
    out = volume.select(F.lit("volume").alias("monitor"), F.lit(None).cast("string").alias("column"), "bucket",
                        F.col("value").cast("double").alias("value"), "z_score", "is_anomaly")
    for p in parts:
        out = out.unionByName(p)
    # A score that rounds to zero has no sign.
    return out.withColumn("z_score", F.when(F.col("z_score") == 0, 0.0).otherwise(F.col("z_score")))
