"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.session import scratch_path

#: White space of every text contract here: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
#: The same as a Java pattern for one word.
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame, name: str, into: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table is the new start of the lineage: a lost executor costs
    only tasks that run after it, and ids made before it never change. Tables
    stay as long as the shared folder keeps them; the path of one that is to go
    earlier is added to ``into``, for ``drop_tables``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    if into is not None:
        into.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs. Spark deletes them when the
    driver's JVM collects the plans that made them, which a driver with little
    to do puts off for long; between steps that shuffle a good part of the
    corpus each, waiting for that doubles the disk needed."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing will read again."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    paths.clear()


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for the actions inside, so that a batch of very
    long texts or of vector tiles still fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_total(df: DataFrame, group: str, order: list[str], value: Column, name: str,
                  bits: int = 9) -> DataFrame:
    """Exclusive running sum ``name`` of ``value`` within ``group`` by ``order``.

    A group may hold any share of the rows, so it is never summed in one task:
    ``order[0]`` must be a long spread evenly over its 64 bits (a hash). Its
    range is cut into 2^bits parts; sums run inside a part, and the totals of
    the parts (at most 2^bits rows a group) give each part's start. ``group``
    must not be null.
    """
    df = df.withColumn("_part", F.shiftright(F.col(order[0]), 64 - bits)).withColumn("_value", value)
    inside = Window.partitionBy(group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(group, "_part").agg(F.sum("_value").alias("_total"))
              .select(group, "_part", F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_start")))
    local = df.withColumn(name, F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return local.join(starts, [group, "_part"]).withColumn(name, F.col(name) + F.col("_start")).drop(
        "_part", "_value", "_start")


def with_small_side(small: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """``small`` marked for broadcast when a count proves it has at most
    ``max_rows`` rows (of a few numbers each); otherwise as it is, so that the
    join shuffles."""
    return F.broadcast(small) if small.count() <= max_rows else small


def bounded_side(small: DataFrame, max_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """``small`` marked for broadcast when its measured size (bytes of its
    texts and digests, 16 a column and row besides) is at most ``max_bytes``;
    otherwise as it is, so that the join shuffles. ``small`` is read for that:
    pass a written table."""
    lengths = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in small.schema.fields
               if f.dataType.typeName() in ("string", "binary")]
    width = sum(lengths, F.lit(16 * (len(small.columns) + 1)))
    used = small.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(small) if used <= max_bytes else small
