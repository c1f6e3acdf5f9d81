"""Stand-in raw incident table derived from the shared test tables.

One incident per ``events`` row (events joined to customer and nation). The
column expressions are plain SQL that Spark and DuckDB evaluate identically,
so the same text defines the Spark input and the oracle's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import RAW_SCHEMA

# Code 160 is primary in the last batch only, but a secondary code in all of
# them; premise 149 gets its text in the last batch only.
_CRIME_CODE = ("CASE WHEN event_id % 53 = 0 AND EXTRACT(DAY FROM ts) > 20 THEN '160' ELSE CASE event_type WHEN 'click' THEN '110' WHEN 'error' THEN '120' "
               "WHEN 'purchase' THEN '130' WHEN 'signup' THEN '140' ELSE '150' END END")


def _date_text(shift: str) -> str:
    d = f"(CAST(ts AS DATE) + CAST({shift} AS INT))"
    return (f"CONCAT(lpad(CAST(CAST(EXTRACT(MONTH FROM {d}) AS INT) AS VARCHAR(12)),2,'0'),'/',"
            f"lpad(CAST(CAST(EXTRACT(DAY FROM {d}) AS INT) AS VARCHAR(12)),2,'0'),'/',"
            f"CAST(CAST(EXTRACT(YEAR FROM {d}) AS INT) AS VARCHAR(12)),' 12:00:00 AM')")


# The fixture definition (column name, SQL expression).
# ``{ts}`` is the engine's name for a time-zone-free timestamp.
FIXTURE_COLUMNS: list[tuple[str, str]] = [
    ("dr_no", "CAST(CAST(event_id AS BIGINT) + CASE WHEN event_id % 100 = 7 THEN 3000000000 ELSE 0 END AS VARCHAR(12))"),
    ("date_rptd", _date_text("(event_id * 37) % 700 + event_id % 5")),
    ("date_occ", _date_text("(event_id * 37) % 700")),
    ("time_occ", "CAST(CAST(EXTRACT(HOUR FROM ts)*100 + EXTRACT(MINUTE FROM ts) AS INT) AS VARCHAR(12))"),
    ("area", "CAST(CAST(n_nationkey AS INT) AS VARCHAR(12))"),
    ("area_name", "n_name"),
    ("rpt_dist_no", "CAST(CAST(n_nationkey*100 + event_id % 100 AS INT) AS VARCHAR(12))"),
    ("part_1_2", "CASE WHEN event_id % 2 = 0 THEN '1' ELSE '2' END"),
    ("crm_cd", _CRIME_CODE),
    ("crm_cd_desc", "CASE WHEN event_id % 53 = 0 AND EXTRACT(DAY FROM ts) > 20 THEN 'late code' ELSE event_type END"),
    ("mocodes", "CASE WHEN event_id % 9 <> 0 THEN CONCAT(lpad(CAST(CAST(100 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS INT) AS VARCHAR(12)),4,'0'),' ',lpad(CAST(CAST(300 + event_id % 40 AS INT) AS VARCHAR(12)),4,'0')) END"),
    ("vict_age", "CASE WHEN user_id % 11 <> 0 THEN CAST(CAST(user_id % 90 AS INT) AS VARCHAR(12)) END"),
    ("vict_sex", "CASE user_id % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'X' WHEN 3 THEN 'H' END"),
    ("vict_descent", "CASE WHEN user_id % 13 <> 0 THEN substr('ABCDFGHIJKLOPSUVWXZ-', CAST(1 + user_id % 20 AS INT), 1) END"),
    ("premis_cd", "CASE WHEN event_id % 37 <> 0 THEN CAST(CAST(100 + event_id % 50 AS INT) AS VARCHAR(12)) END"),
    ("premis_desc", "CASE WHEN event_id % 37 <> 0 AND (event_id % 50 <> 49 OR EXTRACT(DAY FROM ts) > 20) THEN CONCAT('PREMISE ',CAST(CAST(100 + event_id % 50 AS INT) AS VARCHAR(12))) END"),
    ("weapon_used_cd", "CASE WHEN event_id % 3 = 0 THEN CAST(CAST(200 + event_id % 17 AS INT) AS VARCHAR(12)) END"),
    ("weapon_desc", "CASE WHEN event_id % 3 = 0 THEN CONCAT('WEAPON ',CAST(CAST(200 + event_id % 17 AS INT) AS VARCHAR(12)),' V',CAST(CAST(CAST(FLOOR((EXTRACT(DAY FROM ts)-1)/10) AS INT) AS INT) AS VARCHAR(12))) END"),
    ("status", "CASE event_id % 4 WHEN 0 THEN 'IC' WHEN 1 THEN 'AA' WHEN 2 THEN 'AO' ELSE 'JA' END"),
    ("status_desc", "CASE event_id % 4 WHEN 0 THEN 'Invest Cont' WHEN 1 THEN 'Adult Arrest' WHEN 2 THEN 'Adult Other' ELSE 'Juv Arrest' END"),
    ("crm_cd_1", _CRIME_CODE),
    ("crm_cd_2", "CASE WHEN event_id % 3 = 0 THEN CAST(CAST(110 + (event_id % 7)*10 AS INT) AS VARCHAR(12)) END"),
    ("crm_cd_3", f"CASE WHEN event_id % 7 = 0 THEN {_CRIME_CODE} END"),
    ("crm_cd_4", "CAST(NULL AS VARCHAR(12))"),
    ("location", "CONCAT(CAST(CAST((user_id % 60)*100 AS INT) AS VARCHAR(12)),' BLOCK')"),
    ("cross_street", "CASE WHEN user_id % 2 = 0 THEN CONCAT('STREET ',CAST(CAST(user_id % 7 AS INT) AS VARCHAR(12))) END"),
    ("lat", "CASE WHEN user_id % 17 <> 0 THEN CONCAT('34.',lpad(CAST(CAST(user_id % 50 AS INT) AS VARCHAR(12)),4,'0')) END"),
    ("lon", "CASE WHEN user_id % 17 <> 0 THEN CONCAT('-118.',lpad(CAST(CAST(user_id % 40 AS INT) AS VARCHAR(12)),4,'0')) END"),
    ("dl_upd", "CAST(CONCAT('2024-01-',lpad(CAST(CAST(10 + 10*CAST(FLOOR((EXTRACT(DAY FROM ts)-1)/10) AS INT) AS INT) AS VARCHAR(12)),2,'0'),' 23:59:59') AS {ts})"),
]

# The three load stamps the fixture carries.
BATCH_STAMPS = ["2024-01-10 23:59:59", "2024-01-20 23:59:59", "2024-01-30 23:59:59"]


# Largest input that is dealt out over the cores of a test machine.
SPREAD_BYTES = 256 * 1024 * 1024


def fixture_select_list(ts_type: str) -> str:
    return ",\n  ".join(f"{expr.replace('{ts}', ts_type)} AS {name}"
                        for name, expr in FIXTURE_COLUMNS)


def fixture_sql(ts_type: str = "TIMESTAMP") -> str:
    """The fixture as one SELECT over events, customer and nation."""
    return ("SELECT\n  " + fixture_select_list(ts_type) +
            "\nFROM events JOIN customer ON user_id = c_custkey"
            "\nJOIN nation ON c_nationkey = n_nationkey")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan over the cluster's cores when it arrives in fewer
    partitions than that and is at most ``SPREAD_BYTES`` (a small single-file
    table). Anything larger is returned untouched, on any number of cores."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(target) if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < target else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def incident_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incident rows (all text plus a ``timestamp_ntz`` load stamp).

    The customer and nation sides are joined without hints: Catalyst compares
    their Parquet size with ``spark.sql.autoBroadcastJoinThreshold`` and only
    broadcasts them while they are small; otherwise it shuffles.
    """
    path = sf_dir.rstrip("/")
    events = spread(spark.read.parquet(f"{path}/events.parquet")
                    .select("event_id", "ts", "user_id", "event_type", "props"))
    customer = spark.read.parquet(f"{path}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{path}/nation.parquet").select("n_nationkey", "n_name")
    joined = (events.join(customer, F.col("user_id") == F.col("c_custkey"))
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    out = joined.selectExpr(*[f"{expr.replace('{ts}', 'TIMESTAMP_NTZ')} AS {name}"
                              for name, expr in FIXTURE_COLUMNS])
    return out.select([F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields])
