import datetime as dt

from pyspark.sql import functions as F

from blotter.checks import monitors as M
from blotter.checks import rules as C


def by_column(df):
    return {r.column: (r.failures, r.passed) for r in df.collect()}


def test_seeded_defects(spark):
    rows = [(str(i), "2024-01-01") for i in range(20)]
    rows += [(None, "x")] * 3 + [("5", "dup")] * 4 + [("12a", "y"), ("12a", "z")]
    df = spark.createDataFrame(rows, "dr_no string, d string")
    assert by_column(C.check_not_null(df, "t", ["dr_no", "d"])) == {"dr_no": (3, False), "d": (0, True)}
    # '5' occurs 5 times in total, '12a' twice: two duplicated values
    assert by_column(C.check_unique(df, "t", ["dr_no"])) == {"dr_no": (2, False)}
    assert by_column(C.check_regex(df, "t", "dr_no", r"^\d+$")) == {"dr_no": (2, False)}


def test_relationship_counts_orphan_rows(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "a"), (3, "zz"), (4, "zz"), (5, "zz"), (6, "zz"), (7, None)],
                                 "dr_no int, area_dim_id string")
    dim = spark.createDataFrame([("a",), ("b",)], "id string")
    r = C.check_relationship(fact, "area_dim_id", dim, "id", "fct", "dim_area").first()
    assert (r.failures, r.passed) == (4, False)


def test_type_and_schema_changes(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "d date, n int")
    assert C.check_type(spark, df, "t", "d", "date").first().passed
    assert not C.check_type(spark, df, "t", "n", "date").first().passed
    old = spark.createDataFrame([], "a int, b string, c int").schema
    new = spark.createDataFrame([], "a int, c string, e double").schema
    got = sorted((r.column, r.change) for r in M.schema_changes(spark, old, new).collect())
    assert got == [("b", "removed"), ("c", "type_changed"), ("e", "added")]


def test_source_freshness_levels(spark):
    df = spark.createDataFrame([("2024-01-30 00:00:00",)], "ts string").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert M.source_freshness(df, "ts", "2024-01-31 01:00:00").first().status == "warn"
    assert M.source_freshness(df, "ts", "2024-02-01 01:00:00").first().status == "error"
    assert M.source_freshness(df, "ts", "2024-01-30 10:00:00").first().status == "pass"
    assert M.source_freshness(df.filter("false"), "ts", "2024-01-30 10:00:00").first().status == "error"


def test_volume_spike_flagged(spark):
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d, minutes=m)
            for d in range(20) for m in range(10 if d != 17 else 200) if d != 5]
    df = spark.createDataFrame([(t,) for t in days], "ts timestamp_ntz")
    out = {r.bucket: r for r in M.volume_anomalies(df, "ts").collect()}
    assert out[dt.date(2024, 1, 6)].value == 0          # gap day filled with zero
    assert out[dt.date(2024, 1, 18)].is_anomaly
    assert not out[dt.date(2024, 1, 2)].is_anomaly      # too little training data
    assert sum(r.is_anomaly for r in out.values()) >= 1


def test_update_gaps_cross_partition(spark):
    ts = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s) for s in (0, 10, 10, 25, 100, 160, 161)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    gaps = sorted(r.gap_seconds for r in M.update_gaps(df, "ts", num_partitions=3).collect()
                  if r.gap_seconds is not None)
    assert gaps == [1.0, 10.0, 15.0, 60.0, 75.0]


def test_summary(spark):
    df = spark.createDataFrame([(None, "a")], "x string, y string")
    res = C.union_all([C.check_not_null(df, "t", ["x", "y"]), C.check_unique(df, "t", ["y"])])
    r = C.summarise_checks(res).first()
    assert (r.checks, r.passed_checks, r.failed_checks, r.failures) == (3, 2, 1, 1)


def test_multi_key_relationships_match_single(spark):
    fact = spark.createDataFrame([(1, "a", "x"), (2, "zz", "x"), (3, "zz", "q"), (4, None, "q")],
                                 "dr_no int, a_id string, b_id string")
    da = spark.createDataFrame([("a",)], "id string")
    db = spark.createDataFrame([("x",)], "id string")
    multi = by_column(C.check_relationships(fact, "f", [("a_id", da, "id", "dim_a"),
                                                        ("b_id", db, "id", "dim_b")]))
    single = {**by_column(C.check_relationship(fact, "a_id", da, "id", "f", "dim_a")),
              **by_column(C.check_relationship(fact, "b_id", db, "id", "f", "dim_b"))}
    assert multi == single == {"a_id": (2, False), "b_id": (2, False)}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    """A value holding a third of all rows reaches the exchange as one row per
    map task: every grouping in the checks is a partial aggregate."""
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("int").alias("k"))
    parent = spark.range(100).select(F.col("id").cast("int").alias("k"))
    u = C.check_unique(hot, "t", ["k"])
    r = C.check_relationships(hot, "t", [("k", parent, "k", "p")])
    for df in (u, r):
        plan = _plan(df)
        assert "partial_count" in plan, plan
    assert {row.column: row.failures for row in u.collect()} == {"k": 1}
    # child rows whose key (after the hot value 7) is not a parent id 0..99
    assert r.first().failures == 1934


def test_freshness_boundaries_are_strict(spark):
    df = spark.createDataFrame([("2024-01-30 00:00:00",)], "ts string").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert M.source_freshness(df, "ts", "2024-01-31 00:00:00").first().status == "pass"   # 24 h
    assert M.source_freshness(df, "ts", "2024-02-01 00:00:00").first().status == "warn"   # 48 h
