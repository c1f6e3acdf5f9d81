import glob
import os

from pyspark.sql import functions as F

from blotter.operators.history import feed_history, feed_seen
from blotter.operators.snapshot import snapshot_check
from blotter.session import scratch_path
from blotter.sources.snapshots import advance_snapshot, key_range
from blotter.sources.store import TableStore

STAMPS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select("k", "v", "valid_from", "valid_to").collect())


def feed(spark):
    """Loads with new, changed, unchanged, returning and null values, and keys
    that a load does not bring."""
    loads = [[(k, k % 3) for k in range(40)], [(k, k % 2) for k in range(20, 60)],
             [(k, None) for k in range(0, 60, 5)], [(k, k % 3) for k in range(0, 60, 4)]]
    return [(s, spark.createDataFrame(part, "k long, v long")) for s, part in zip(STAMPS, loads)]


def test_table_equals_the_rewritten_snapshot_and_the_one_pass_history(spark):
    store = TableStore(spark, scratch_path(spark, "snap"), hash_parts=5)
    whole, every = None, None
    for number, (stamp, part) in enumerate(feed(spark), 1):
        whole = snapshot_check(whole, part, "k", ["v"], stamp).checkpoint(eager=True)
        table = advance_snapshot(store, "s", "t", part, ["k"], ["v"], stamp, number)
        assert rows(table) == rows(whole)
        assert store.rows("s", "t") == whole.count() and store.watermark("s", "t") == number
        stamped = part.withColumn("stamp", F.lit(stamp).cast("timestamp_ntz"))
        every = stamped if every is None else every.unionByName(stamped)
    assert rows(feed_history(every, ["k"], ["v"], "stamp")) == rows(whole)
    again = advance_snapshot(store, "s", "t", part, ["k"], ["v"], stamp, number)   # run again: nothing moves
    assert rows(again) == rows(whole)
    seen = {r.k: (str(r.doe), str(r.dlu)) for r in feed_seen(every, ["k"], "stamp").collect()}
    assert seen[0] == (STAMPS[0], STAMPS[3]) and seen[59] == (STAMPS[1], STAMPS[1])


def _files(store):
    root = store._live_path("s", "t").replace("file:", "")
    return {p: os.path.getmtime(p) for p in glob.glob(root + "/dr_part=*/*.parquet")}


def test_small_load_replaces_only_the_ranges_of_its_keys(spark):
    store = TableStore(spark, scratch_path(spark, "snap-small"), hash_parts=8)
    df = spark.range(400).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v"))
    advance_snapshot(store, "s", "t", df, ["k"], ["v"], STAMPS[0], 1)
    part = df.filter("k = 7").withColumn("v", F.lit(1).cast("long"))
    touched = part.select(key_range(["k"], 8)).first()[0]
    before = _files(store)
    got = advance_snapshot(store, "s", "t", part, ["k"], ["v"], STAMPS[1], 2)
    after = _files(store)
    own = (f"dr_part={touched}/", f"dr_part={touched + 8}/")
    others = {p for p in before if not any(o in p for o in own)}
    assert len(others) >= 7 and all(after.get(p) == before[p] for p in others)
    assert got.filter("valid_to IS NOT NULL").count() == 1 and got.count() == 401
    # a key that is new: its closed range is not touched either
    before = _files(store)
    new = spark.createDataFrame([(1000, 5)], "k long, v long")
    advance_snapshot(store, "s", "t", new, ["k"], ["v"], STAMPS[2], 3)
    after = _files(store)
    assert all(after.get(p) == before[p] for p in before if f"dr_part={touched + 8}/" in p)


def test_history_has_one_exchange(spark):
    df = spark.range(10).repartition(3).select(F.col("id").alias("k"), F.rand().alias("v"), F.rand().alias("stamp"))
    plan = feed_history(df, ["k"], ["v"], "stamp")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_empty_feed(spark):
    df = spark.createDataFrame([], "k long, v long, stamp timestamp_ntz")
    assert feed_history(df, ["k"], ["v"], "stamp").count() == 0 == feed_seen(df, ["k"], "stamp").count()
