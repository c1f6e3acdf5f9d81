"""Dimension models."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.calendar import date_spine, part_of_day
from blotter.functions.keys import double_text, surrogate_key
from blotter.operators.dedupe import latest_by, latest_label
from blotter.operators.incremental import since_watermark, ts_literal
from blotter.operators.snapshot import snapshot_check

# Default calendar range, end exclusive.
DATE_START, DATE_END = "2019-01-01", "2030-12-31"


@dataclass(frozen=True)
class CodeDim:
    """A code -> label dimension taken from staging."""
    name: str
    code: str
    label: str
    label_as: str
    not_null: tuple[str, ...]
    unique_key: str
    update_cols: tuple[str, ...] | None
    incremental: bool


CODE_DIMS: dict[str, CodeDim] = {d.name: d for d in [
    CodeDim("dim_area", "area", "area_name", "name", (), "id", None, False),
    CodeDim("dim_status", "status", "status_desc", "description", ("status",), "id",
            ("code", "description", "source_dlu", "dlu"), True),
    CodeDim("dim_premise", "premis_cd", "premis_desc", "description",
            ("premis_cd", "premis_desc"), "id", ("description", "source_dlu", "dlu"), True),
    CodeDim("dim_weapon", "weapon_used_cd", "weapon_desc", "description", ("weapon_used_cd",),
            "id", ("code", "description", "source_dlu", "dlu"), True),
    CodeDim("dim_crime_code", "crm_cd", "crm_cd_desc", "description", (), "id",
            ("code", "description", "source_dlu", "dlu"), True),
]}


def code_dim(stg: DataFrame, spec: CodeDim, load_ts, watermark=None,
             by: str = "dl_upd") -> DataFrame:
    """Latest label per code among staged rows whose ``by`` is above
    ``watermark``. A null code is a code like any other (one row).

    One row per code even when a code was loaded with several labels or
    stamps (latest stamp wins, then the greatest label).
    """
    return from_labels(code_labels(since_watermark(stg, by, watermark), [spec]), stg, spec, load_ts)


def code_labels(stg: DataFrame, specs: list[CodeDim]) -> DataFrame:
    """``dim, code, label, source_dlu``: newest stamp per code and label of
    several dimensions in one scan and one partial aggregate (codes as text)."""
    pairs = []
    for spec in specs:
        pair = F.struct(F.lit(spec.name).alias("dim"), F.col(spec.code).cast("string").alias("code"),
                        F.col(spec.label).alias("label"))
        for c in spec.not_null:
            pair = F.when(F.col(c).isNotNull(), pair)
        pairs.append(pair)
    rows = stg.select("dl_upd", F.explode(F.array(*pairs)).alias("p")).filter("p IS NOT NULL")
    return rows.groupBy("p.dim", "p.code", "p.label").agg(F.max("dl_upd").alias("source_dlu"))


def from_labels(labels: DataFrame, stg: DataFrame, spec: CodeDim, load_ts) -> DataFrame:
    """One dimension out of ``code_labels``."""
    own = labels.filter(F.col("dim") == spec.name).select(
        F.col("code").cast(stg.schema[spec.code].dataType).alias("code"),
        F.col("label").alias(spec.label_as), "source_dlu")
    latest = latest_label(own, "code", spec.label_as, "source_dlu")
    return latest.select(surrogate_key("code").alias("id"), "code", spec.label_as,
                         "source_dlu", ts_literal(load_ts).alias("dlu"))


def dim_victim(stg: DataFrame, descent: DataFrame, load_ts, watermark=None,
               by: str = "dl_upd") -> DataFrame:
    """Victim groups (age, sex, descent description).

    The 19-row descent seed is broadcast and joined before the aggregate, so
    the map side reduces rows to one per group before any shuffle.
    """
    src = since_watermark(stg, by, watermark).select(
        "vict_age", "vict_sex", "vict_descent", "dl_upd")
    m = F.broadcast(descent.select(F.col("descent_code").alias("__code"),
                                   F.col("descent_description").alias("descent")))
    mapped = src.join(m, F.col("vict_descent") == F.col("__code"), "left").select(
        F.col("vict_age").alias("age"), F.col("vict_sex").alias("sex"), F.col("descent"),
        F.col("dl_upd").alias("source_dlu"))
    latest = mapped.groupBy("age", "sex", "descent").agg(F.max("source_dlu").alias("source_dlu"))
    return latest.select(surrogate_key("age", "sex", "descent").alias("id"),
                         "age", "sex", "descent", "source_dlu", ts_literal(load_ts).alias("dlu"))


def dim_mocode(mocodes: DataFrame, load_ts) -> DataFrame:
    return mocodes.select(surrogate_key("mocodes").alias("id"), F.col("mocodes").alias("code"),
                          "description", ts_literal(load_ts).alias("dlu"))


def location_key(prefix: str = ""):
    return surrogate_key(F.col(prefix + "location"), F.col(prefix + "cross_street"),
                         double_text(prefix + "lat"), double_text(prefix + "lon"))


LOCATION_CHECK_COLS = ["location", "cross_street", "lat", "lon"]


def location_incoming(stg: DataFrame, load_ts, watermark=None, by: str = "dl_upd") -> DataFrame:
    """Distinct places (location, cross street, lat, lon) among staged rows
    newer than ``watermark``, keyed by their hash, latest stamp per key.
    Grouping on the hash keeps ids unique even for doubles that print alike."""
    src = since_watermark(stg, by, watermark).select(
        *LOCATION_CHECK_COLS, F.col("dl_upd").alias("source_dlu"))
    # Plain columns first (a hash aggregate), then the ids of what is left.
    places = src.groupBy(*LOCATION_CHECK_COLS).agg(F.max("source_dlu").alias("source_dlu"))
    latest = latest_by(places.withColumn("id", location_key()), ["id"], ["source_dlu"])
    return latest.select("id", *LOCATION_CHECK_COLS, "source_dlu",
                         ts_literal(load_ts).alias("dlu"))


def dim_location(stg: DataFrame, load_ts, current: DataFrame | None = None,
                 watermark=None, incoming_rows: int | None = None) -> DataFrame:
    """Location snapshot: change history with ``valid_from`` / ``valid_to``.

    The key is the hash of the compared columns, so a place already in the
    snapshot can never compare different; only places staged since the last
    run (``watermark``) need comparing, which gives the same table as
    comparing every staged place."""
    return snapshot_check(current, location_incoming(stg, load_ts, watermark), "id",
                          LOCATION_CHECK_COLS, load_ts, incoming_rows=incoming_rows)


def newer_only(incoming: DataFrame, current: DataFrame, order: list[str]) -> DataFrame:
    """Rows of ``incoming(id, ...)`` without the ones whose ``order`` is below
    that of the current row: a late load with an older stamp does not replace
    a newer label."""
    old = current.select(F.col("id").alias("__id"), F.struct(*order).alias("__order"))
    older = (F.col("id") == F.col("__id")) & (F.struct(*order) < F.col("__order"))
    return incoming.join(old, older, "left_anti")


def dim_date(spark: SparkSession, load_ts, start: str | dt.date = DATE_START,
             end: str | dt.date = DATE_END) -> DataFrame:
    """Calendar days in ``[start, end)``. Day of week 0 = Sunday; ISO week."""
    d = F.col("date_day")
    dow = F.dayofweek(d) - 1
    stamp = ts_literal(load_ts)
    return date_spine(spark, start, end).select(
        surrogate_key(d).alias("id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.upper(F.date_format(d, "MMM")).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        dow.isin(0, 6).alias("is_weekend"),
        stamp.alias("doe"),
        stamp.alias("dlu"),
    )


def dim_time(spark: SparkSession, load_ts) -> DataFrame:
    """Minutes of the day (1,440 rows), generated by ``range`` with div/mod."""
    m = F.col("id")
    hour = (m / 60).cast("int")
    minute = (m % 60).cast("int")
    return spark.range(0, 24 * 60).select(
        surrogate_key(hour, minute).alias("id"),
        hour.alias("hour_of_day"),
        minute.alias("minute_of_hour"),
        part_of_day(hour).alias("part_of_day"),
        ts_literal(load_ts).alias("doe"),
    )
