"""Explicit schemas. Nothing in the mart infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw incident columns in file order (the landing CSV carries them as text; the
# load stamp dl_upd is added by the loader, not read from the file).
RAW_TEXT_COLUMNS = [
    "dr_no", "date_rptd", "date_occ", "time_occ", "area", "area_name",
    "rpt_dist_no", "part_1_2", "crm_cd", "crm_cd_desc", "mocodes", "vict_age",
    "vict_sex", "vict_descent", "premis_cd", "premis_desc", "weapon_used_cd",
    "weapon_desc", "status", "status_desc", "crm_cd_1", "crm_cd_2", "crm_cd_3",
    "crm_cd_4", "location", "cross_street", "lat", "lon",
]

LANDING_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_TEXT_COLUMNS])

RAW_SCHEMA = T.StructType(
    list(LANDING_SCHEMA.fields) + [T.StructField("dl_upd", T.TimestampNTZType(), True)])

MOCODE_SEED_SCHEMA = T.StructType([
    T.StructField("mocodes", T.IntegerType(), True),
    T.StructField("description", T.StringType(), True),
])

DESCENT_SEED_SCHEMA = T.StructType([
    T.StructField("descent_code", T.StringType(), True),
    T.StructField("descent_description", T.StringType(), True),
])

# Output shape shared by every data check (one row per check).
CHECK_RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("table", T.StringType(), False),
    T.StructField("column", T.StringType(), True),
    T.StructField("failures", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])
