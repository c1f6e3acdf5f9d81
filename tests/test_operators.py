import pytest
from pyspark.sql import functions as F

from blotter.operators.dedupe import latest_by
from blotter.operators.incremental import high_watermark, since_watermark
from blotter.operators.joins import bounded_broadcast
from blotter.operators.merge import (DuplicateKeyError, carry_first_seen, merge_upsert,
                                     sync_columns)
from blotter.operators.snapshot import current_versions, snapshot_check

T = "k int, v string, ts string"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_latest_by_ties_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a", "1"), (1, "b", "2"), (1, "c", "2"), (None, "x", "1"),
                                (None, "y", "0")], T)
    out = latest_by(df, ["k"], ["ts"])
    assert {r.k: (r.v, r.ts) for r in out.collect()} == {1: ("c", "2"), None: ("x", "1")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_merge_upsert_branches(spark, broadcast_rows):
    target = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t1"), (3, "c", "t1")], T)
    source = spark.createDataFrame([(2, "B", "t2"), (3, "c", "t2"), (4, "d", "t2"), (None, "n", "t2")], T)
    out = merge_upsert(target, source, ["k"], change_cols=["v"], with_action=True,
                       broadcast_rows=broadcast_rows)
    got = sorted(rows(out, "k", "v", "ts", "_action"), key=str)
    assert got == sorted([(1, "a", "t1", "keep"), (2, "B", "t2", "update"), (3, "c", "t1", "unchanged"),
                          (4, "d", "t2", "insert"), (None, "n", "t2", "insert")], key=str)


def test_merge_update_cols_subset_and_duplicates(spark):
    target = spark.createDataFrame([(1, "a", "t1")], T)
    source = spark.createDataFrame([(1, "A", "t2")], T)
    out = merge_upsert(target, source, ["k"], update_cols=["v"])
    assert rows(out, "k", "v", "ts") == [(1, "A", "t1")]
    dup = spark.createDataFrame([(1, "x", "t"), (1, "y", "t")], T)
    with pytest.raises(DuplicateKeyError):
        merge_upsert(target, dup, ["k"])


def test_merge_small_source_does_not_shuffle_target(spark):
    target = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"),
                                      F.lit("t").alias("ts"))
    source = spark.createDataFrame([(5, "b", "t2")], T)
    out = merge_upsert(target, source, ["k"], source_rows=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_sync_columns(spark):
    target = spark.createDataFrame([(1, "a", 5)], "k int, old string, n int")
    incoming = spark.createDataFrame([(1, "x", 5)], "k int, new string, n long")
    out = sync_columns(target, incoming)
    assert out.columns == ["k", "new", "n"] and out.schema["n"].dataType.simpleString() == "bigint"
    assert out.first().new is None
    with pytest.raises(TypeError):
        sync_columns(target, spark.createDataFrame([(1, 2)], "k string, n int"))


def test_carry_first_seen(spark):
    target = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "k int, doe string").withColumn(
        "doe", F.col("doe").cast("timestamp_ntz"))
    inc = spark.createDataFrame([(1,), (2,)], "k int")
    out = carry_first_seen(inc, target, ["k"], "2024-01-05 00:00:00")
    got = {r.k: (str(r.doe), str(r.dlu)) for r in out.collect()}
    assert got == {1: ("2024-01-01 00:00:00", "2024-01-05 00:00:00"),
                   2: ("2024-01-05 00:00:00", "2024-01-05 00:00:00")}


def test_since_watermark(spark):
    df = spark.createDataFrame([(1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-02 00:00:00"),
                                (3, "c", None)], T).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert since_watermark(df, "ts", None).count() == 3
    wm = high_watermark(df.filter("k = 1"), "ts")
    assert rows(since_watermark(df, "ts", wm), "k") == [(2,)]
    assert high_watermark(None, "ts") is None


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_snapshot_check_history(spark, broadcast_rows):
    s1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    snap = snapshot_check(None, s1, "k", ["v"], "2024-01-01 00:00:00")
    same = snapshot_check(snap, s1, "k", ["v"], "2024-01-02 00:00:00", broadcast_rows=broadcast_rows)
    assert rows(same, "k", "v", "valid_from") == rows(snap, "k", "v", "valid_from")
    s2 = spark.createDataFrame([(1, "A"), (3, "c")], "k int, v string")
    snap2 = snapshot_check(snap, s2, "k", ["v"], "2024-01-03 00:00:00", broadcast_rows=broadcast_rows)
    got = sorted((r.k, r.v, str(r.valid_from), str(r.valid_to)) for r in snap2.collect())
    assert got == [(1, "A", "2024-01-03 00:00:00", "None"), (1, "a", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
                   (2, "b", "2024-01-01 00:00:00", "None"), (3, "c", "2024-01-03 00:00:00", "None")]
    assert current_versions(snap2).count() == 3


def test_bounded_broadcast(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    j1 = big.join(bounded_broadcast(small, rows=10, max_rows=50), "k")
    assert "BroadcastHashJoin" in j1._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j2 = big.join(bounded_broadcast(small, max_rows=5), "k")
        assert "BroadcastHashJoin" not in j2._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
