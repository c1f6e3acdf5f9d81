import datetime as dt
import hashlib

import pytest

from blotter.functions.calendar import date_spine, hhmm_parts
from blotter.functions.codes import code_array, explode_codes, split_int_codes
from blotter.functions.keys import NULL_TOKEN, double_text, surrogate_key
from blotter.functions.share import grid_bucket, pct_half_up, share_of_group
from blotter.plans.dims import dim_date, dim_time


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_surrogate_key_text_and_nulls(spark):
    df = spark.createDataFrame([(110, "a", None), (110, "", None)], "c int, s string, n string")
    rows = df.select(surrogate_key("c").alias("k1"), surrogate_key("c", "s").alias("k2"),
                     surrogate_key("n", "c").alias("k3")).collect()
    assert rows[0].k1 == md5("110")
    assert rows[0].k2 == md5("110-a")
    assert rows[1].k2 == md5("110-")
    assert rows[0].k3 == md5(f"{NULL_TOKEN}-110")
    assert rows[0].k2 != rows[1].k2


def test_double_key_text(spark):
    df = spark.createDataFrame([(34.0025,), (1.0e7,), (-118.0,)], "x double")
    assert [r[0] for r in df.select(double_text("x")).collect()] == [
        "34.00250000", "10000000.00000000", "-118.00000000"]


def test_date_spine_end_exclusive(spark):
    assert date_spine(spark, "2024-01-01", "2024-01-04").count() == 3
    assert date_spine(spark, "2024-01-04", "2024-01-01").count() == 0
    assert date_spine(spark, "2019-01-01", "2030-12-31").count() == 4382


def test_dim_date_parts(spark):
    rows = {r.full_date: r for r in dim_date(spark, "2024-01-01 00:00:00", "2020-12-31", "2021-01-04").collect()}
    fri = rows[dt.date(2021, 1, 1)]
    assert (fri.week_of_year, fri.day_of_week, fri.day_name, fri.month_name, fri.is_weekend) == (
        53, 5, "Friday", "JAN", False)
    sun = rows[dt.date(2021, 1, 3)]
    assert (sun.day_of_week, sun.is_weekend, sun.quarter) == (0, True, 1)


def test_dim_time_grid(spark):
    t = dim_time(spark, "2024-01-01 00:00:00")
    assert t.count() == 1440 and t.select("id").distinct().count() == 1440
    parts = {r.hour_of_day: r.part_of_day for r in t.filter("minute_of_hour = 0").collect()}
    assert (parts[0], parts[5], parts[6], parts[11], parts[12], parts[17], parts[18], parts[23]) == (
        "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening")


def test_hhmm_parts(spark):
    df = spark.createDataFrame([("5",), ("1230",), ("2359",), (None,)], "t string")
    h, m = hhmm_parts("t")
    assert [(r[0], r[1]) for r in df.select(h, m).collect()] == [(0, 5), (12, 30), (23, 59), (None, None)]
    with pytest.raises(Exception):
        spark.createDataFrame([("2460",)], "t string").select(*hhmm_parts("t")).collect()


def test_pct_half_up_exact_halves(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 800), (0, 5), (5, 5)], "c long, t long")
    assert [r[0] for r in df.select(pct_half_up("c", "t")).collect()] == [12.5, 33.33, 66.67, 0.13, 0.0, 100.0]


def test_grid_bucket_rounds_decimal_half_up(spark):
    df = spark.createDataFrame([(34.0025,), (-118.0025,), (34.0024,), (None,)], "x double")
    assert [r[0] for r in df.select(grid_bucket("x")).collect()] == [34.003, -118.003, 34.002, None]


def test_split_and_explode_codes(spark):
    df = spark.createDataFrame([(1, "0416  0417 x 0416", 10, 20, 10, None), (2, None, None, None, None, None)],
                               "k int, mo string, a int, b int, c int, d int")
    assert df.select(split_int_codes("mo")).first()[0] == [416, 417]
    ex = explode_codes(df, ["k"], code_array("a", "b", "c", "d")).collect()
    assert sorted((r.k, r.code) for r in ex) == [(1, 10), (1, 20)]


def test_share_of_group(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), (None, "x")], "g string, v string")
    out = {(r.g, r.v): (r.n, r.total, r.pct) for r in share_of_group(df, ["g", "v"], ["g"]).collect()}
    assert out == {("a", "x"): (2, 3, 66.67), ("a", "y"): (1, 3, 33.33), (None, "x"): (1, 1, 100.0)}
    with pytest.raises(ValueError):
        share_of_group(df, ["v"], ["g"])


def test_seeds_load_typed(spark):
    from blotter.sources.seeds import load_seed, seed_path
    mo = load_seed(spark, "mocodes")
    assert mo.schema.simpleString() == "struct<mocodes:int,description:string>"
    rows = {r.mocodes: r.description for r in mo.collect()}
    assert len(rows) == 118 and 105 not in rows and 101 in rows and "," in rows[101]
    assert load_seed(spark, "descent_mapping").count() == 19
    # the same file through Spark's CSV scan gives the same rows
    assert sorted(load_seed(spark, "mocodes", "file://" + seed_path("mocodes")).collect()) == sorted(mo.collect())


def test_report_number_must_be_canonical(spark):
    from blotter.plans.staging import report_number
    ok = spark.createDataFrame([("7",), ("123",), (None,)], "dr_no string")
    assert [r[0] for r in ok.select(report_number()).collect()] == [7, 123, None]
    with pytest.raises(Exception, match="canonical"):
        spark.createDataFrame([("007",)], "dr_no string").select(report_number()).collect()
