"""Global row positions without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.session import scratch_path

#: ``monotonically_increasing_id`` holds the row number of a partition in its
#: low 33 bits.
_LOCAL_BITS = 33


def with_position(df: DataFrame, order: list[Column], name: str = "position",
                  partitions: int | None = None) -> DataFrame:
    """``df`` with the zero-based place of each row by ``order`` in column
    ``name`` (a long).

    Rows are range-partitioned on ``order`` and sorted inside each partition;
    the numbered partitions are written once (so the layout is fixed, also when
    executors are lost) and each partition's start is the sum of the counts
    before it: one row per partition, joined back by broadcast. Nothing larger
    than that passes one task. Rows that tie in ``order`` take neighbouring
    places in any order; add columns to make the places unique. An empty table
    gives no rows."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "positions")
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema(ranged.withColumn("__row", F.lit(0).cast("long")).schema).parquet(path)
    part = F.shiftright("__row", _LOCAL_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
              .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    local = F.col("__row").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
            .withColumn(name, F.col("__start") + local).drop("__part", "__start", "__row"))


def with_running_sums(df: DataFrame, order: list[Column], sums: dict[str, str], name: str = "position",
                      block_bits: int = 16) -> DataFrame:
    """``df`` with its global position by ``order`` and, for each ``sums`` item
    (result column -> summed column), the sum over all rows before it.

    Sums run inside blocks of 2^``block_bits`` neighbours; only the blocks'
    totals pass one task."""
    placed = with_position(df, order, name).withColumn("__block", F.shiftright(name, block_bits))
    inside = Window.partitionBy("__block").orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("__block").agg(*[F.sum(c).alias(f"__{k}") for k, c in sums.items()]).select(
        "__block", *[F.coalesce(F.sum(f"__{k}").over(across), F.lit(0)).alias(f"__{k}") for k in sums])
    return placed.join(totals, "__block").select(
        *df.columns, name, *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__{k}")).alias(k)
                             for k, c in sums.items()])
