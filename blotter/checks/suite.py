"""The data checks declared for the mart, run as the last step of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.checks import monitors as M
from blotter.checks import rules as C
from blotter.checks import states as S

# The checks declared on the mart (table -> columns).
ID_TABLES = ["dim_area", "dim_status", "dim_premise", "dim_weapon", "dim_victim", "dim_date",
             "dim_time", "dim_mocode", "dim_location"]
NOT_NULL = {
    "dim_date": ["id", "full_date", "year", "month", "month_name", "day", "day_of_week", "day_name",
                 "week_of_year", "quarter", "is_weekend", "doe", "dlu"],
    "dim_time": ["id", "hour_of_day", "minute_of_hour", "part_of_day", "doe"],
    "dim_area": ["id", "code", "name", "source_dlu", "dlu"],
    "dim_crime_code": ["id", "code", "description", "source_dlu", "dlu"],
    "dim_status": ["id", "code", "description", "source_dlu", "dlu"],
    "dim_weapon": ["id", "code", "description", "source_dlu", "dlu"],
    "dim_premise": ["id"],
    "dim_victim": ["id"],
    "dim_mocode": ["id", "code", "description", "dlu"],
    "dim_location": ["id"],
    "bridge_mocode": ["dr_no", "mocode_dim_id", "doe", "dlu"],
    "fct_incidents": ["dr_no", "date_occ_id", "date_rptd_id", "time_occ_id"],
}
FACT_LINKS = [("date_occ_id", "dim_date"), ("date_rptd_id", "dim_date"), ("time_occ_id", "dim_time"),
              ("victims_id", "dim_victim"), ("weapons_id", "dim_weapon"),
              ("status_dim_id", "dim_status"), ("area_dim_id", "dim_area"),
              ("premis_dim_id", "dim_premise"), ("location_dim_id", "dim_location")]


SOURCE_NOT_NULL = ["dr_no", "date_rptd", "date_occ", "time_occ", "area"]


class DataCheckError(RuntimeError):
    pass


def mart_checks(star) -> DataFrame:
    """Every declared check of the mart as rows of (check, table, column,
    failures, passed). Each table's not-null and pattern checks share one
    scan; all fact foreign keys share one scan."""
    spark = star.store.spark
    t = star.table
    parts = []
    for name, cols in NOT_NULL.items():
        regex = {"dr_no": r"^\d+$"} if name == "fct_incidents" else None
        parts.append(C.check_columns(t(name), name, not_null=cols, regex=regex))
    for name in ID_TABLES:
        parts.append(C.check_unique(t(name), name, ["id"]))
    parts.append(C.check_unique(t("dim_crime_code"), "dim_crime_code", ["id", "code"]))
    parts.append(C.check_unique(t("dim_mocode"), "dim_mocode", ["code"]))
    parts.append(C.check_unique(t("fct_incidents"), "fct_incidents", ["dr_no"]))
    parts.append(C.check_relationships(t("fct_incidents"), "fct_incidents",
                                       [(fk, t(dim), "id", dim) for fk, dim in FACT_LINKS]))
    for col in ("doe", "dlu"):
        parts.append(C.check_type(spark, t("fct_incidents"), "fct_incidents", col, "timestamp"))
    return C.union_all(parts)


def source_checks(raw: DataFrame) -> DataFrame:
    """The checks declared on the raw table: required columns, unique report
    numbers."""
    return C.union_all([C.check_not_null(raw, "raw_incidents", SOURCE_NOT_NULL),
                        C.check_unique(raw, "raw_incidents", ["dr_no"])])


def freshness_gate(raw: DataFrame, now) -> DataFrame:
    """Source freshness at ``now``; an error fails the run."""
    found = M.source_freshness(raw, "dl_upd", now)
    row = found.first()
    if row["status"] == "error":
        raise DataCheckError(f"source is stale: newest row {row['max_loaded_at']}, {row['age_hours']} hours old")
    return found


def monitors(star, area_report: DataFrame | None) -> DataFrame:
    """The monitors declared on the mart: ``(monitor, table, column, bucket,
    value, z_score, is_anomaly)``. Findings are recorded; they do not fail a
    run. What grows with the data (fact, incidents) is read from stored states
    that a run advances by the partitions its load has replaced."""
    t = star.table
    days = S.incident_findings(S.incident_days(star.store)).withColumnRenamed("column", "of")

    def rows(found: DataFrame, monitor: str, table: str, column) -> DataFrame:
        return found.select(F.lit(monitor).alias("monitor"), F.lit(table).alias("table"), column.alias("column"),
                            F.col("bucket").cast("string").alias("bucket"), F.col("value").cast("double").alias("value"),
                            "z_score", "is_anomaly")

    parts = [rows(days.filter("monitor = 'volume'"), "volume", "raw_incidents", F.col("of")),
             rows(days.filter("monitor = 'column'"), "column", "raw_incidents", F.col("of")),
             rows(M.freshness_anomalies(S.fact_stamps(star.store), "dlu"), "freshness", "fct_incidents", F.lit("dlu")),
             rows(M.column_anomalies(t("dim_victim"), "age", "source_dlu"), "column", "dim_victim",
                  F.concat(F.lit("age:"), F.col("metric")))]
    if area_report is not None:
        parts.append(rows(M.volume_anomalies(area_report, "dlu"), "volume", "area_monthly_summary",
                          F.lit(None).cast("string")))
    for name in ("dim_area", "fct_incidents"):
        drift = M.schema_changes_since_last_run(star.store, "mart_core", name)
        parts.append(drift.select(F.lit("schema_change").alias("monitor"), F.lit(name).alias("table"), "column",
                                  F.col("change").alias("bucket"), F.lit(None).cast("double").alias("value"),
                                  F.lit(None).cast("double").alias("z_score"), F.lit(True).alias("is_anomaly")))
    return C.union_all(parts)


def raise_on_failures(results: DataFrame) -> None:
    """Fail the run when any check failed (at most five failures fetched)."""
    bad = results.filter("NOT passed").limit(5).collect()
    if bad:
        raise DataCheckError("data checks failed: " + "; ".join(
            f"{r['check']} {r['table']}.{r['column']}: {r['failures']}" for r in bad))
