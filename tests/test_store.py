import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from blotter.session import conform_session, scratch_path
from blotter.sources.store import FEW_PARTS, TableStore


def test_versions_meta_and_half_written_folders(spark):
    store = TableStore(spark, scratch_path(spark, "store-test"))
    df = spark.range(10).select(F.col("id").cast("int").alias("k"),
                                F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))
    store.write(df, "s", "t", watermark_col="ts")
    assert store.rows("s", "t") == 10 and str(store.watermark("s", "t")) == "2024-01-01 00:00:00"
    # a version folder left behind by a lost job: invisible, and never reused
    broken = store._version_path("s", "t", 2).replace("file:", "")
    os.makedirs(broken)
    open(os.path.join(broken, "part-0.parquet"), "w").close()
    assert store.versions("s", "t") == [1]
    assert store.read("s", "t").count() == 10
    store.write(df.filter("k < 3"), "s", "t")
    assert store.versions("s", "t") == [3] or store.versions("s", "t")[-1] == 3
    assert store.read("s", "t").count() == 3 and store.rows("s", "t") == 3


def test_bucketed_table_survives_a_new_catalog_entry(spark):
    store = TableStore(spark, scratch_path(spark, "store-bucket"), buckets=4)
    df = spark.range(100).select(F.col("id").cast("int").alias("dr_no"))
    store.write_live(df, "s", "f", ["dr_no"], 1)
    qualified = store._catalog_name("s", "f")
    spark.sql(f"DROP TABLE {qualified}")           # as in a fresh session
    again = store.read("s", "f")
    assert again.count() == 100
    assert "Bucketed: true" in again._jdf.queryExecution().executedPlan().toString()


def test_first_load_with_duplicate_keys_is_never_published(spark):
    from blotter.operators.merge import DuplicateKeyError
    from blotter.plans import pipeline as P
    from blotter.schemas import RAW_SCHEMA
    store = TableStore(spark, scratch_path(spark, "dup-load"))
    row = tuple(["1"] + [None] * (len(RAW_SCHEMA.fields) - 2)) + (None,)
    batch = spark.createDataFrame([row, row], RAW_SCHEMA)
    with pytest.raises(DuplicateKeyError):
        P.load_raw(store, batch)
    assert store.read(P.RAW, P.RAW_TABLE) is None
    ok = spark.createDataFrame([row], RAW_SCHEMA)
    P.load_raw(store, ok)
    assert store.read(P.RAW, P.RAW_TABLE).count() == 1


def test_schema_changes_since_last_run(spark):
    from blotter.checks.monitors import schema_changes_since_last_run
    store = TableStore(spark, scratch_path(spark, "schema-drift"))
    store.write(spark.createDataFrame([(1, "a", 2)], "k int, old string, n int"), "s", "t")
    assert schema_changes_since_last_run(store, "s", "t").count() == 0
    store.write(spark.createDataFrame([(1, "x", 2)], "k int, new string, n bigint"), "s", "t")
    got = sorted((r.column, r.change) for r in schema_changes_since_last_run(store, "s", "t").collect())
    assert got == [("n", "type_changed"), ("new", "added"), ("old", "removed")]


def _files(store, name):
    import glob
    root = store._live_path("s", name).replace("file:", "")
    return {p: os.path.getmtime(p) for p in glob.glob(root + "/dr_part=*/*.parquet")}


def test_live_table_replaces_only_the_partitions_written(spark):
    store = TableStore(spark, scratch_path(spark, "store-live"), buckets=2, part_width=100)
    df = spark.range(1000).select(F.col("id").alias("dr_no"), F.lit(0).alias("v"))
    store.write_live(df, "s", "f", ["dr_no"], 1)
    before = _files(store, "f")
    assert store.touched(df.filter("dr_no BETWEEN 250 AND 349"), "s", "f") == [2, 3]
    rows = store.read_live("s", "f").filter("dr_part IN (2, 3)").drop("dr_part").withColumn("v", F.lit(7))
    store.write_live(rows, "s", "f", ["dr_no"], 2)
    after = _files(store, "f")
    kept = {p for p in before if "dr_part=2/" not in p and "dr_part=3/" not in p}
    assert all(after.get(p) == before[p] for p in kept)
    assert not (set(before) - kept) & set(after)
    got = store.read("s", "f")
    assert got.count() == 1000 and got.filter("v = 7").count() == 200 and store.watermark("s", "f") == 2


def test_live_table_keeps_the_layout_of_its_first_write(spark):
    root = scratch_path(spark, "store-layout")
    first = TableStore(spark, root, buckets=2, part_width=100)
    df = spark.range(300).select(F.col("id").alias("dr_no"))
    first.write_live(df, "s", "f", ["dr_no"], 1)
    again = TableStore(spark, root, buckets=16, part_width=7)
    again.write_live(again.read_live("s", "f").filter("dr_part = 1").drop("dr_part"), "s", "f", ["dr_no"], 2)
    assert again.read("s", "f").count() == 300
    assert again.live_buckets("s", "f") == 2
    assert len(_files(again, "f")) <= 6


def _one_part(store, df):
    """Write ``df`` (rows of partition 1 only) and check that no other file moved."""
    before = _files(store, "f")
    store.write_live(df, "s", "f", ["dr_no"], 2)
    after = _files(store, "f")
    others = {p for p in before if "dr_part=1/" not in p}
    assert others and all(after.get(p) == before[p] for p in others)
    return store.read("s", "f")


def test_a_new_column_writes_no_old_file(spark):
    from blotter.checks.monitors import schema_changes_since_last_run
    store = TableStore(spark, scratch_path(spark, "store-columns"), buckets=2, part_width=100)
    df = spark.range(300).select(F.col("id").alias("dr_no"), F.lit(1).alias("n"))
    store.write_live(df, "s", "f", ["dr_no"], 1)
    got = _one_part(store, df.filter("dr_no BETWEEN 100 AND 199").withColumn("new", F.lit("x")))
    assert got.columns == ["dr_no", "n", "new"] and got.count() == 300
    assert got.filter("new = 'x'").count() == 100 and got.filter("new IS NULL").count() == 200
    assert [(r.column, r.change) for r in schema_changes_since_last_run(store, "s", "f").collect()] == [("new", "added")]
    again = TableStore(spark, store.root)
    spark.sql(f"DROP TABLE {again._catalog_name('s', 'f')}")     # as in a fresh session
    assert again.read("s", "f").filter("new = 'x'").count() == 100


def test_a_widened_or_dropped_column_writes_no_old_file(spark):
    store = TableStore(spark, scratch_path(spark, "store-widen"), buckets=2, part_width=100)
    df = spark.range(300).select(F.col("id").alias("dr_no"), F.lit(1).alias("n"), F.lit("o").alias("old"))
    store.write_live(df, "s", "f", ["dr_no"], 1)
    part = df.filter("dr_no BETWEEN 100 AND 199")
    got = _one_part(store, part.select("dr_no", F.lit(1 << 40).alias("n")))
    assert got.dtypes == [("dr_no", "bigint"), ("n", "bigint")]
    assert got.filter("n = 1").count() == 200 and got.filter(f"n = {1 << 40}").count() == 100
    with pytest.raises(ValueError, match="dropped"):
        store.write_live(part.select("dr_no", F.lit(2).cast("long").alias("n"), F.lit("o").alias("old")),
                         "s", "f", ["dr_no"], 3)


def test_parallel_loads_in_a_session_with_its_own_settings(spark, monkeypatch):
    """Three tables loaded side by side, a slow insert, a thread that flips the
    session's overwrite mode: every table keeps its other partitions and the
    session is not changed."""
    from concurrent.futures import ThreadPoolExecutor
    from pyspark.sql import DataFrameWriter
    conf = "spark.sql.sources.partitionOverwriteMode"
    assert spark.conf.get(conf).lower() == "static"
    store = TableStore(spark, scratch_path(spark, "store-threads"), buckets=2, part_width=100)
    df = spark.range(800).select(F.col("id").alias("dr_no"), F.lit(0).alias("v"))
    names = ["a", "b", "c"]
    for n in names:
        store.write_live(df, "s", n, ["dr_no"], 0)
    insert = DataFrameWriter.insertInto

    def slow(self, *args, **kw):
        time.sleep(0.2)
        return insert(self, *args, **kw)
    monkeypatch.setattr(DataFrameWriter, "insertInto", slow)
    stop = threading.Event()

    def flip():
        while not stop.is_set():
            for mode in ("dynamic", "static"):
                spark.conf.set(conf, mode)
                time.sleep(0.01)
    flipper = threading.Thread(target=flip)
    flipper.start()
    try:
        for round_ in range(1, 4):
            def load(n):
                part = store.read_live("s", n).filter("dr_part = 3").drop("dr_part")
                return store.write_live(part.withColumn("v", F.lit(round_)), "s", n, ["dr_no"], round_)
            with ThreadPoolExecutor(3) as pool:
                list(pool.map(load, names))
            for n in names:
                got = store.read("s", n)
                assert got.count() == 800 and got.filter(f"v = {round_}").count() == 100
    finally:
        stop.set()
        flipper.join()
        spark.conf.unset(conf)
    monkeypatch.undo()
    spark.conf.set(conf, "static")
    store.write_live(store.read_live("s", "a").filter("dr_part = 3").drop("dr_part"), "s", "a", ["dr_no"], 9)
    assert spark.conf.get(conf).lower() == "static"
    spark.conf.unset(conf)


def test_row_counts_are_those_of_the_written_rows(spark):
    store = TableStore(spark, scratch_path(spark, "store-rows"))
    store.write(spark.range(1000).repartition(7), "s", "t", sort_within=["id"])
    assert store.rows("s", "t") == 1000


def test_layout_follows_the_rows_and_not_the_report_numbers(spark, sf_small):
    """Report numbers far apart, more shuffle partitions than cores: few files
    in every live table, the same partitions in all, and the same rows."""
    import glob
    from blotter.plans import pipeline as P
    from blotter.sources.fixture import incident_fixture
    number = F.col("dr_no").cast("long")
    fx = incident_fixture(spark, sf_small).filter(number % 7 == 0)
    far = fx.withColumn("dr_no", (number * 60_000_000).cast("string"))
    stores = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for name, batch in (("near", fx), ("far", far)):
            store = TableStore(spark, scratch_path(spark, f"layout-{name}"))
            P.load_raw(store, batch.filter("area <> '3'"))
            P.run_models(spark, store, "2024-02-01 00:00:00")
            P.load_raw(store, batch)
            stores.append((store, P.run_models(spark, store, "2024-02-02 00:00:00")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    (_, near_star), (store, far_star) = stores
    cores = spark.sparkContext.defaultParallelism
    parts = set()
    for schema, t in ((P.RAW, P.RAW_TABLE), (P.CORE, "fct_incidents"), (P.CORE, "bridge_crime_code")):
        path = store._live_path(schema, t).replace("file:", "")
        parts |= {os.path.basename(p) for p in glob.glob(path + "/dr_part=*")}
        assert store.layout(schema, t) == store.layout(P.RAW, P.RAW_TABLE)
        assert len(glob.glob(path + "/dr_part=*/*.parquet")) <= 2 * 5 * min(40, cores), t
    assert 1 < len(parts) <= 5
    for t in ("fct_incidents", "bridge_crime_code"):
        near = near_star.table(t).withColumn("dr_no", F.col("dr_no") * 60_000_000)
        rows = far_star.table(t)
        assert rows.count() == near.count() > 0
        assert rows.exceptAll(near).count() == 0


def test_large_merge_shuffles_only_the_source_into_fewer_buckets(spark):
    """Fewer buckets than shuffle partitions: the target still stays in place."""
    from blotter.operators.merge import merge_upsert
    store = TableStore(spark, scratch_path(spark, "few-buckets"), buckets=3)
    rows = spark.range(300).select("id", F.lit(1).alias("v")).withColumnRenamed("id", "dr_no")
    target = store.write_live(rows, "s", "f", ["dr_no"], 1)
    source = spark.range(200, 400).select(F.col("id").alias("dr_no"), F.lit(2).alias("v"))
    merged = merge_upsert(target, source, ["dr_no"], source_rows=200, broadcast_rows=0,
                          insert_partitioning=(3, ["dr_no"]))
    merged.write.format("noop").mode("overwrite").save()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert {(r.v, r["n"]) for r in merged.groupBy("v").agg(F.count("*").alias("n")).collect()} == {(1, 200), (2, 200)}


def test_large_bridge_merge_shuffles_only_the_source(spark, monkeypatch):
    """Merge keys are more than the bucket's: the target stays in its buckets
    and the result is written without another exchange."""
    from blotter.operators import merge as M
    from blotter.plans import pipeline as P
    conform_session(spark)
    store = TableStore(spark, scratch_path(spark, "bridge-merge"), buckets=3)
    rows = lambda lo, hi, v: spark.range(lo, hi).select(
        (F.col("id") / 3).cast("long").alias("dr_no"), (F.col("id") % 3).alias("code"), F.lit(v).alias("dlu"))
    store.write_live(rows(0, 300, 1), P.CORE, "b", ["dr_no"], 1)
    inc = store.write(rows(200, 400, 2).unionByName(rows(0, 2, 3).withColumn("dr_no", F.lit(None).cast("long"))),
                      P.INCREMENTS, "b")
    monkeypatch.setattr(M, "fits_broadcast", lambda *a: False)
    plans, how = [], []
    write = TableStore.write_live

    def watched(self, df, *a, **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        how.append(k.get("prepartitioned"))
        return write(self, df, *a, **k)

    monkeypatch.setattr(TableStore, "write_live", watched)
    out = P._merge_live(store, "b", inc, ["dr_no", "code"], ["dlu"], 2)
    assert plans[0].count("Exchange hashpartitioning") == 1 and how == [True]
    assert {(r.dlu, r["n"]) for r in out.groupBy("dlu").agg(F.count("*").alias("n")).collect()} == {(1, 200), (2, 200), (3, 2)}


def test_session_generates_only_methods_that_the_jvm_compiles(spark):
    """A session made elsewhere has Spark's own limit, under which the wide
    projections ran interpreted."""
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "65535")
    conform_session(spark)
    assert int(spark.conf.get(key)) <= 8000


def test_layout_counts_ranges_before_widths(spark, monkeypatch):
    """The widths are counted on the ranges with rows, and come out as counted
    on the rows: numbers below zero, no numbers and strays included."""
    store = TableStore(spark, scratch_path(spark, "fit"), buckets=3)
    for numbers in ([], [None], [-60_000_000, 5, None, 70_000_000], [i * 90_000_000 for i in range(40)],
                    [7, 7, 3 * 10**15, -(10**12)], [10**18, None, 1]):
        df = spark.createDataFrame([(None if n is None else str(n),) for n in numbers], "dr_no string")
        ranges = lambda w: {-1 if n is None else int(n / w) if abs(n) < 2**52 else n // w for n in numbers}
        wanted = max(FEW_PARTS, 2 * -(-len(numbers) // 10_000_000))
        width = next(w for w in (50_000_000 << k for k in range(38)) if len(ranges(w)) <= wanted)
        assert store.fit_layout(df, "dr_no") == (3, width)
    many = spark.range(1000).select(F.col("id").cast("string").alias("dr_no"))
    seen = []
    monkeypatch.setattr(type(many), "first", lambda df, first=type(many).first: seen.append(
        df._jdf.queryExecution().analyzed().toString()) or first(df))
    store.fit_layout(many, "dr_no")
    assert seen[0].count("Aggregate") == 2


def test_live_write_sorts_once(spark, monkeypatch):
    """The writer sorts by partition, bucket and key; no other sort before it."""
    store = TableStore(spark, scratch_path(spark, "one-sort"), buckets=2, part_width=100)
    calls = []
    df = spark.range(300).select((299 - F.col("id")).alias("dr_no"))
    sort = type(df).sortWithinPartitions
    monkeypatch.setattr(type(df), "sortWithinPartitions", lambda df, *a, **k: calls.append(a) or sort(df, *a, **k))
    store.write_live(df, "s", "t", ["dr_no"], 1)
    assert calls == []
    files = spark.read.parquet(store.path("s", "t") + "/live").select("dr_no", F.input_file_name().alias("f"),
                                                                      F.monotonically_increasing_id().alias("at")).collect()
    per_file = {}
    for r in sorted(files, key=lambda r: r.at):
        per_file.setdefault(r.f, []).append(r.dr_no)
    assert len(per_file) == 6 and all(v == sorted(v) for v in per_file.values())
