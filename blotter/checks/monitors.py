"""Freshness, schema drift and z-score anomaly monitors.

Metrics are first reduced to one row per time bucket (a partial aggregate),
so the trailing-window z-score runs over a short series (one row per day and
metric), never over raw rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.incremental import ts_literal

# Default training window (buckets) and z threshold.
TRAIN_BUCKETS, Z_THRESHOLD = 14, 3.0


def source_freshness(df: DataFrame, ts_col: str, now, warn_hours: float = 24,
                     error_hours: float = 48) -> DataFrame:
    """One row: newest stamp, its age in hours at ``now`` and
    ``pass / warn / error`` (strict ``>``; an empty source is ``error``)."""
    mx = F.max(F.col(ts_col)).alias("max_loaded_at")
    one = df.agg(mx)
    age = ((ts_literal(now).cast("timestamp").cast("long")
            - F.col("max_loaded_at").cast("timestamp").cast("long")) / F.lit(3600.0))
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(F.col("age_hours") > error_hours, "error")
              .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))
    return one.withColumn("age_hours", age).withColumn("status", status)


def schema_changes(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """Columns added, removed or retyped between two schemas (no scan)."""
    o = {f.name: f.dataType.simpleString() for f in old.fields}
    n = {f.name: f.dataType.simpleString() for f in new.fields}
    rows = [(c, "added", None, n[c]) for c in n if c not in o]
    rows += [(c, "removed", o[c], None) for c in o if c not in n]
    rows += [(c, "type_changed", o[c], n[c]) for c in n if c in o and o[c] != n[c]]
    return spark.createDataFrame(rows, "column string, change string, old_type string, new_type string")


def schema_changes_since_last_run(store, schema: str, name: str) -> DataFrame:
    """Columns added, removed or retyped between a table's two newest
    writes, from the schemas stored with them (no scan). Empty when the table
    was written once."""
    spark = store.spark
    meta = store.meta(schema, name) or {}
    if meta.get("previous_schema"):
        old, new = (T.StructType.fromJson(json.loads(meta[k])) for k in ("previous_schema", "schema"))
        return schema_changes(spark, old, new)
    vs = store.versions(schema, name)
    if len(vs) < 2:
        return schema_changes(spark, T.StructType([]), T.StructType([])).limit(0)
    return schema_changes(spark, store.version_schema(schema, name, vs[-2]),
                          store.version_schema(schema, name, vs[-1]))


def z_score_anomalies(series: DataFrame, bucket: str = "bucket", value: str = "value",
                      by: list[str] | None = None, train: int = TRAIN_BUCKETS,
                      z: float = Z_THRESHOLD, digits: int = 4) -> DataFrame:
    """Add the trailing mean / sample stddev over the previous ``train``
    buckets (current excluded), the z-score and an anomaly flag.

    Fewer than two training buckets: no score, not an anomaly. Stddev 0: no
    score, anomaly iff the value differs from the mean.
    """
    by = by or []
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(bucket).rowsBetween(-train, -1)
    v = F.col(value).cast("double")
    out = (series.withColumn("train_n", F.count(v).over(w))
           .withColumn("train_mean", F.avg(v).over(w))
           .withColumn("train_stddev", F.stddev_samp(v).over(w)))
    enough = F.col("train_n") >= 2
    score = F.when(enough & (F.col("train_stddev") > 0),
                   (v - F.col("train_mean")) / F.col("train_stddev"))
    anomaly = (F.when(~enough, F.lit(False))
               .when(F.col("train_stddev") > 0, F.abs(score) > z)
               .otherwise(v != F.col("train_mean")))
    return (out.withColumn("z_score", F.round(score, digits))
            .withColumn("train_mean", F.round("train_mean", digits))
            .withColumn("train_stddev", F.round("train_stddev", digits))
            .withColumn("is_anomaly", F.coalesce(anomaly, F.lit(False))))


def daily_volume(df: DataFrame, ts_col: str) -> DataFrame:
    """Rows per day; days without rows inside the observed span count 0."""
    return every_day(df.select(F.to_date(F.col(ts_col)).alias("bucket"))
                     .filter(F.col("bucket").isNotNull())
                     .groupBy("bucket").agg(F.count(F.lit(1)).alias("value")))


def every_day(counts: DataFrame) -> DataFrame:
    """``counts(bucket, value)`` with 0 for the days between that have none."""
    # The span comes from the counts within the plan; their exchange is reused.
    days = (counts.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).filter("lo IS NOT NULL")
            .select(F.explode(F.expr("sequence(lo, hi, INTERVAL 1 DAY)")).alias("bucket")))
    return (days.join(counts, "bucket", "left")
            .select("bucket", F.coalesce("value", F.lit(0)).cast("long").alias("value")))


def volume_anomalies(df: DataFrame, ts_col: str, train: int = TRAIN_BUCKETS,
                     z: float = Z_THRESHOLD) -> DataFrame:
    return z_score_anomalies(daily_volume(df, ts_col), "bucket", "value", train=train, z=z)


def update_gaps(df: DataFrame, ts_col: str, num_partitions: int | None = None) -> DataFrame:
    """Seconds between each distinct update time and the previous one.

    Distinct times are range-partitioned (a busy day is split over many
    tasks), written to the checkpoint folder so the partitioning is fixed,
    then ordered inside each partition; the first row of a partition takes its
    predecessor from the previous partition's last time (a table with one row
    per partition).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    times = df.select(F.col(ts_col).alias("ts")).filter(F.col("ts").isNotNull()).distinct()
    ranged = (times.repartitionByRange(n, "ts").withColumn("pid", F.spark_partition_id())
              .checkpoint(eager=True))
    bounds = (ranged.groupBy("pid").agg(F.max("ts").alias("last"))
              .withColumn("prev_last", F.lag("last").over(Window.orderBy("pid")))
              .select("pid", "prev_last"))
    w = Window.partitionBy("pid").orderBy("ts")
    with_prev = (ranged.withColumn("prev", F.lag("ts").over(w))
                 .join(F.broadcast(bounds), "pid")
                 .withColumn("prev", F.coalesce("prev", "prev_last")))
    secs = ((F.unix_micros(F.col("ts").cast("timestamp"))
             - F.unix_micros(F.col("prev").cast("timestamp"))) / F.lit(1e6))
    return with_prev.select("ts", "prev", secs.alias("gap_seconds"))


def freshness_anomalies(df: DataFrame, ts_col: str, train: int = TRAIN_BUCKETS,
                        z: float = Z_THRESHOLD) -> DataFrame:
    """Largest gap between successive update times, per day of the later
    update, scored like volume."""
    gaps = update_gaps(df, ts_col).filter(F.col("gap_seconds").isNotNull())
    series = (gaps.groupBy(F.to_date("ts").alias("bucket"))
              .agg(F.max("gap_seconds").alias("value")))
    return z_score_anomalies(series, "bucket", "value", train=train, z=z)


def column_metrics(df: DataFrame, col: str, ts_col: str) -> DataFrame:
    """Per day: null count and percent, min, max, average, sample stddev and
    zero count of ``col``, one row per (day, metric)."""
    c = F.col(col).cast("double")
    per_day = df.groupBy(F.to_date(F.col(ts_col)).alias("bucket")).agg(
        F.sum(c.isNull().cast("long")).cast("double").alias("null_count"),
        (F.sum(c.isNull().cast("long")) * 100.0 / F.count(F.lit(1))).cast("double").alias("null_percent"),
        F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("average"),
        F.stddev_samp(c).alias("standard_deviation"),
        F.sum(F.coalesce((c == 0).cast("long"), F.lit(0))).cast("double").alias("zero_count"))
    return per_metric(per_day)


METRICS = ["null_count", "null_percent", "min", "max", "average", "standard_deviation", "zero_count"]


def per_metric(per_day: DataFrame) -> DataFrame:
    """``(bucket, metric, value)`` out of one column per metric."""
    return per_day.select("bucket", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])).alias("m")
    ).select("bucket", "m.metric", "m.value")


def column_anomalies(df: DataFrame, col: str, ts_col: str, train: int = TRAIN_BUCKETS,
                     z: float = Z_THRESHOLD) -> DataFrame:
    return metric_anomalies(column_metrics(df, col, ts_col), train, z)


def metric_anomalies(metrics: DataFrame, train: int = TRAIN_BUCKETS, z: float = Z_THRESHOLD) -> DataFrame:
    series = metrics.withColumn("value", F.round("value", 6))
    return z_score_anomalies(series, "bucket", "value", by=["metric"], train=train, z=z)
