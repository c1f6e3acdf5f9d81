"""Reporting models over the star schema.

Each report counts facts (or fact x bridge rows) per group and, for four of
them, the share of each count in a wider group. Common shape of the plans:

* dimensions that only relabel a key are joined *after* counting: the fact is
  first reduced by a partial hash aggregate on its foreign keys (eager
  aggregation), so the shuffle carries one row per key combination per task
  instead of one row per incident;
* the one join of two incident-sized inputs (fact x crime-code bridge on
  ``dr_no``) moves only integer columns: both sides are narrowed through
  broadcast lookups (calendar, time, crime code) before the exchange;
* the share window runs on the aggregated rows only.

Every report is its counts (``*_counts``: fact rows, or fact x bridge rows, per
key) and what is made of them (``*_report``: labels, totals, shares). Counts can
be added and subtracted, so the scheduled run keeps them from load to load (see
``plans/deltas``); a full refresh counts all facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.share import grid_bucket, share_of_counts
from blotter.operators.incremental import ts_literal
from blotter.operators.joins import bounded_broadcast, fits_broadcast
from blotter.operators.snapshot import current_versions


def _rows(rows: dict | None, name: str):
    return (rows or {}).get(name)


# Order of each report's rows (nulls last); no two rows tie.
ORDER = {
    "area_monthly_summary": ["area_code", "area_name", "year", "month"],
    "crime_code_seasonality": ["crime_code", "month_number"],
    "location_density": ["lat_bucket", "lon_bucket", "crime_code", "year", "month_number", "time_of_day"],
    "victim_demographics": ["victim_age", "victim_sex", "victim_descent"],
    "weapon_distribution": ["area_name", "part_of_day", "weapon_type"],
}


def report_order(name: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ORDER[name]]


def _ordered(df: DataFrame, name: str) -> DataFrame:
    return df.orderBy(*report_order(name))


AREA_KEYS = ["date_occ_id", "area_dim_id"]
MONTH_KEYS = ["crime_code", "month_number"]
CELL_KEYS = ["lat_bucket", "lon_bucket", "crime_code", "year", "month_number", "time_of_day"]
VICTIM_KEYS = ["victims_id"]
WEAPON_KEYS = ["time_occ_id", "area_dim_id", "weapons_id"]


def _count(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def area_counts(fact: DataFrame) -> DataFrame:
    return _count(fact, AREA_KEYS)


def area_report(counts: DataFrame, dim_date: DataFrame, dim_area: DataFrame, load_ts,
                rows: dict | None = None) -> DataFrame:
    """Incidents per area and month of occurrence. Left joins: facts whose
    date or area key is missing still count, under null labels."""
    d = bounded_broadcast(dim_date.select(F.col("id").alias("__d"), "year", "month"),
                          _rows(rows, "dim_date"))
    a = bounded_broadcast(dim_area.select(F.col("id").alias("__a"), F.col("code").alias("area_code"),
                                          F.col("name").alias("area_name")), _rows(rows, "dim_area"))
    j = (counts.join(d, F.col("date_occ_id") == F.col("__d"), "left")
         .join(a, F.col("area_dim_id") == F.col("__a"), "left"))
    out = (j.groupBy("area_code", "area_name", "year", "month")
           .agg(F.sum("n").cast("long").alias("crime_count"))
           .withColumn("dlu", ts_literal(load_ts)))
    return _ordered(out, "area_monthly_summary")


def area_monthly_summary(fact: DataFrame, dim_date: DataFrame, dim_area: DataFrame, load_ts,
                         rows: dict | None = None) -> DataFrame:
    return area_report(area_counts(fact), dim_date, dim_area, load_ts, rows)


def _coded_incidents(fact: DataFrame, bridge: DataFrame, dim_crime_code: DataFrame,
                     fact_cols: list, rows: dict | None) -> DataFrame:
    """fact x crime-code bridge on ``dr_no`` with the code resolved.

    The bridge is narrowed to (dr_no, code) through a broadcast of the crime
    dimension before the exchange."""
    c = bounded_broadcast(dim_crime_code.select(F.col("id").alias("__c"),
                                                F.col("code").alias("crime_code")),
                          _rows(rows, "dim_crime_code"))
    b = (bridge.select("dr_no", "crime_code_dim_id")
         .join(c, F.col("crime_code_dim_id") == F.col("__c"), "inner")
         .select("dr_no", "crime_code"))
    return fact.select("dr_no", *fact_cols).join(b, "dr_no", "inner")


def _month_name(month_number: str = "month_number"):
    """Month label as the calendar dimension spells it (``JAN``), from the number."""
    return F.upper(F.date_format(F.make_date(F.lit(2000), F.col(month_number), F.lit(1)), "MMM"))


def _crime_labels(dim_crime_code: DataFrame) -> DataFrame:
    return dim_crime_code.select(F.col("code").alias("crime_code"),
                                 F.col("description").alias("crime_description"))


def month_counts(fact: DataFrame, bridge: DataFrame, dim_crime_code: DataFrame, dim_date: DataFrame,
                 rows: dict | None = None) -> DataFrame:
    d = bounded_broadcast(dim_date.select(F.col("id").alias("__d"),
                                          F.col("month").alias("month_number")),
                          _rows(rows, "dim_date"))
    f = (fact.select("dr_no", "date_occ_id")
         .join(d, F.col("date_occ_id") == F.col("__d"), "inner").select("dr_no", "month_number"))
    return _count(_coded_incidents(f, bridge, dim_crime_code, ["month_number"], rows), MONTH_KEYS)


def seasonality_report(counts: DataFrame, dim_crime_code: DataFrame, rows: dict | None = None) -> DataFrame:
    """Share of each calendar month in a crime code's (fact x bridge) rows,
    all years pooled."""
    labelled = (counts.withColumnRenamed("n", "crime_count").withColumn("month", _month_name())
                .join(bounded_broadcast(_crime_labels(dim_crime_code), _rows(rows, "dim_crime_code")),
                      "crime_code", "inner"))
    out = share_of_counts(labelled, ["crime_code"], "crime_count", "total_by_crime",
                          "month_percentage")
    out = out.select("crime_code", "crime_description", "month", "month_number",
                     "crime_count", "total_by_crime", "month_percentage")
    return _ordered(out, "crime_code_seasonality")


def crime_code_seasonality(fact: DataFrame, bridge: DataFrame, dim_crime_code: DataFrame,
                           dim_date: DataFrame, rows: dict | None = None) -> DataFrame:
    return seasonality_report(month_counts(fact, bridge, dim_crime_code, dim_date, rows), dim_crime_code, rows)


def cell_counts(fact: DataFrame, bridge: DataFrame, dim_crime_code: DataFrame,
                dim_date: DataFrame, dim_time: DataFrame, dim_location: DataFrame,
                rows: dict | None = None) -> DataFrame:
    """(fact x bridge) rows per grid cell (lat/lon rounded to 3 places), code,
    year, month and part of day.

    The location dimension grows with the data, so the plan depends on its
    written row count: within the broadcast bound it is joined to the fact
    first (the fact then carries two grid coordinates instead of a key, and
    the counts aggregate straight to grid cells); beyond it the counts are
    first reduced per location key and only the reduced rows are joined to
    the dimension."""
    d = bounded_broadcast(dim_date.select(F.col("id").alias("__d"), "year",
                                          F.col("month").alias("month_number")),
                          _rows(rows, "dim_date"))
    t = bounded_broadcast(dim_time.select(F.col("id").alias("__t"),
                                          F.col("part_of_day").alias("time_of_day")),
                          _rows(rows, "dim_time"))
    f = (fact.select("dr_no", "location_dim_id", "date_occ_id", "time_occ_id")
         .join(d, F.col("date_occ_id") == F.col("__d"), "inner")
         .join(t, F.col("time_occ_id") == F.col("__t"), "inner")
         .select("dr_no", "location_dim_id", "year", "month_number", "time_of_day"))
    loc = current_versions(dim_location).select(
        F.col("id").alias("location_dim_id"),
        grid_bucket("lat").alias("lat_bucket"), grid_bucket("lon").alias("lon_bucket"))
    keys = ["crime_code", "year", "month_number", "time_of_day"]
    loc_rows = _rows(rows, "dim_location")
    if loc_rows is not None and fits_broadcast(loc_rows, loc.schema):
        f = (f.join(F.broadcast(loc), "location_dim_id", "inner")
             .select("dr_no", "lat_bucket", "lon_bucket", "year", "month_number", "time_of_day"))
        return _count(_coded_incidents(f, bridge, dim_crime_code,
                                       ["lat_bucket", "lon_bucket", "year", "month_number", "time_of_day"], rows),
                      CELL_KEYS)
    per_loc = _count(_coded_incidents(f, bridge, dim_crime_code,
                                      ["location_dim_id", "year", "month_number", "time_of_day"], rows),
                     ["location_dim_id", *keys])
    return (per_loc.join(bounded_broadcast(loc, loc_rows), "location_dim_id", "inner")
            .groupBy(*CELL_KEYS).agg(F.sum("n").cast("long").alias("n")))


def density_report(counts: DataFrame, dim_crime_code: DataFrame, rows: dict | None = None) -> DataFrame:
    """Counts per grid cell, code, month, year and part of day with each
    count's share of its grid cell."""
    labelled = (counts.withColumnRenamed("n", "crime_count").withColumn("month", _month_name())
                .join(bounded_broadcast(_crime_labels(dim_crime_code), _rows(rows, "dim_crime_code")),
                      "crime_code", "inner"))
    out = share_of_counts(labelled, ["lat_bucket", "lon_bucket"], "crime_count",
                          "total_crimes_in_grid", "crime_density_percentage")
    out = out.select("lat_bucket", "lon_bucket", "crime_code", "crime_description", "month",
                     "year", "month_number", "time_of_day", "crime_count",
                     "total_crimes_in_grid", "crime_density_percentage")
    return _ordered(out, "location_density")


def location_density(fact: DataFrame, bridge: DataFrame, dim_crime_code: DataFrame,
                     dim_date: DataFrame, dim_time: DataFrame, dim_location: DataFrame,
                     rows: dict | None = None) -> DataFrame:
    counts = cell_counts(fact, bridge, dim_crime_code, dim_date, dim_time, dim_location, rows)
    return density_report(counts, dim_crime_code, rows)


def victim_counts(fact: DataFrame) -> DataFrame:
    return _count(fact.filter(F.col("victims_id").isNotNull()), VICTIM_KEYS)


def victim_report(counts: DataFrame, dim_victim: DataFrame, rows: dict | None = None) -> DataFrame:
    """Incidents per victim group with each descent's share within its
    (age, sex) group."""
    v = bounded_broadcast(dim_victim.select(F.col("id").alias("victims_id"),
                                            F.col("age").alias("victim_age"),
                                            F.col("sex").alias("victim_sex"),
                                            F.col("descent").alias("victim_descent")),
                          _rows(rows, "dim_victim"))
    counted = (counts.join(v, "victims_id", "inner")
               .groupBy("victim_age", "victim_sex", "victim_descent")
               .agg(F.sum("n").cast("long").alias("incident_count")))
    out = share_of_counts(counted, ["victim_age", "victim_sex"], "incident_count",
                          "total_by_age_sex", "descent_percentage")
    return _ordered(out, "victim_demographics")


def victim_demographics(fact: DataFrame, dim_victim: DataFrame,
                        rows: dict | None = None) -> DataFrame:
    return victim_report(victim_counts(fact), dim_victim, rows)


def weapon_counts(fact: DataFrame) -> DataFrame:
    return _count(fact.filter(F.col("weapons_id").isNotNull()), WEAPON_KEYS)


def weapon_report(counts: DataFrame, dim_time: DataFrame, dim_area: DataFrame,
                  dim_weapon: DataFrame, rows: dict | None = None) -> DataFrame:
    """Incidents with a known weapon per area and part of day, with each
    weapon's share."""
    t = bounded_broadcast(dim_time.select(F.col("id").alias("time_occ_id"), "part_of_day"),
                          _rows(rows, "dim_time"))
    a = bounded_broadcast(dim_area.select(F.col("id").alias("area_dim_id"),
                                          F.col("name").alias("area_name")), _rows(rows, "dim_area"))
    w = bounded_broadcast(dim_weapon.select(F.col("id").alias("weapons_id"),
                                            F.col("description").alias("weapon_type")),
                          _rows(rows, "dim_weapon"))
    counted = (counts.join(t, "time_occ_id", "inner").join(a, "area_dim_id", "inner")
               .join(w, "weapons_id", "inner")
               .groupBy("area_name", "part_of_day", "weapon_type")
               .agg(F.sum("n").cast("long").alias("weapon_count")))
    out = share_of_counts(counted, ["area_name", "part_of_day"], "weapon_count",
                          "total_crimes", "weapon_type_percentage")
    return _ordered(out, "weapon_distribution")


def weapon_distribution(fact: DataFrame, dim_time: DataFrame, dim_area: DataFrame,
                        dim_weapon: DataFrame, rows: dict | None = None) -> DataFrame:
    return weapon_report(weapon_counts(fact), dim_time, dim_area, dim_weapon, rows)
