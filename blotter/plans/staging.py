"""Staging: typed, recoded projection of the raw incident table (a lazy view)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.calendar import hhmm_parts, parse_incident_date

# Number of the load that last wrote a raw row (see pipeline.load_raw).
LOAD_SEQ = "load_seq"

# Number of the load whose merge inserted a dimension row (not part of the
# dimension's own columns, see pipeline.late_keys).
FIRST_LOAD = "first_load"

# Victim sex recode; anything else becomes null.
SEX_LABELS = {"M": "Male", "F": "Female", "X": "Unknown"}


def recode_sex(c: str = "vict_sex"):
    expr = None
    for code, label in SEX_LABELS.items():
        cond = F.col(c) == F.lit(code)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(None).cast("string"))


def report_number(c: str = "dr_no"):
    """The report number as a long. Text that is not the canonical form of its
    number (``007``, ``7 ``) fails the job: the raw table is keyed by the
    text, so two spellings of one number would collide in every table keyed
    by the number (fact, bridges). A per-row check, no shuffle."""
    n = F.col(c).cast("long")
    ok = F.col(c).isNull() | (n.cast("string") == F.col(c))
    err = F.raise_error(F.concat(F.lit("report number is not a canonical integer: "), F.col(c)))
    return F.when(ok, n).otherwise(err.cast("long"))


def stg_incidents(raw: DataFrame) -> DataFrame:
    """Cast and recode raw rows. Narrow: every expression is per row and stays
    inside one whole-stage-codegen span; Catalyst prunes it to the columns a
    consumer actually uses, down to the Parquet scan."""
    hour, minute = hhmm_parts("time_occ")
    i = lambda c: F.col(c).cast("int").alias(c)
    return raw.select(
        report_number().alias("dr_no"),
        parse_incident_date("date_rptd").alias("date_rptd"),
        parse_incident_date("date_occ").alias("date_occ"),
        F.format_string("%02d:%02d:00", hour, minute).alias("time_occ"),
        hour.alias("hour_occ"),
        minute.alias("minute_occ"),
        i("area"),
        F.col("area_name"),
        i("rpt_dist_no"),
        i("crm_cd"),
        F.col("crm_cd_desc"),
        F.col("mocodes"),
        i("vict_age"),
        recode_sex().alias("vict_sex"),
        F.col("vict_descent"),
        i("premis_cd"),
        F.col("premis_desc"),
        i("weapon_used_cd"),
        F.col("weapon_desc"),
        F.col("status"),
        F.col("status_desc"),
        i("crm_cd_1"), i("crm_cd_2"), i("crm_cd_3"), i("crm_cd_4"),
        F.col("location"),
        F.col("cross_street"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        F.col("dl_upd"),
        *[F.col(LOAD_SEQ)] * (LOAD_SEQ in raw.columns),
    )
