"""Independent DuckDB SQL for every registered query.

Written from the raw fixture with plain joins on codes, windows and
``row_number``; surrogate keys appear only as ``md5`` text where a query
returns them. Views ``events customer nation orders ...`` are registered by
the caller over the same Parquet files the Spark side reads.
"""

from __future__ import annotations

import os

from blotter.sources.fixture import BATCH_STAMPS, fixture_sql

SEED_DIR = os.path.join(os.path.dirname(os.path.abspath(__file__)), "blotter", "sources", "seed_data")
RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"
S1, S2, S3 = (f"TIMESTAMP '{s}'" for s in BATCH_STAMPS)
NULL_TOKEN = "'_dbt_utils_surrogate_key_null_'"
DATE_LO, DATE_HI = "DATE '2019-01-01'", "DATE '2030-12-31'"


def md5_key(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), {NULL_TOKEN})" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def dec(e: str) -> str:
    return f"CAST(CAST({e} AS DECIMAL(18,8)) AS VARCHAR)"


def bucket(e: str) -> str:
    return f"CAST(ROUND(CAST({e} AS DECIMAL(18,8)), 3) AS DOUBLE)"


def pct(c: str, t: str) -> str:
    return f"CAST(({c} * 20000 + {t}) // (2 * {t}) AS DOUBLE) / 100"


PART_OF_DAY = ("CASE WHEN {h} BETWEEN 0 AND 5 THEN 'Night' WHEN {h} BETWEEN 6 AND 11 THEN 'Morning' "
               "WHEN {h} BETWEEN 12 AND 17 THEN 'Afternoon' WHEN {h} BETWEEN 18 AND 23 THEN 'Evening' "
               "ELSE 'Unknown' END")

RAW = f"raw AS ({fixture_sql('TIMESTAMP')})"

STG_SELECT = """
  SELECT CAST(dr_no AS BIGINT) AS dr_no,
    CAST(strptime(date_rptd, '%m/%d/%Y %I:%M:%S %p') AS DATE) AS date_rptd,
    CAST(strptime(date_occ, '%m/%d/%Y %I:%M:%S %p') AS DATE) AS date_occ,
    printf('%02d:%02d:00', CAST(substr(lpad(time_occ, 4, '0'), 1, 2) AS INTEGER),
           CAST(substr(lpad(time_occ, 4, '0'), 3, 2) AS INTEGER)) AS time_occ,
    CAST(substr(lpad(time_occ, 4, '0'), 1, 2) AS INTEGER) AS hour_occ,
    CAST(substr(lpad(time_occ, 4, '0'), 3, 2) AS INTEGER) AS minute_occ,
    CAST(area AS INTEGER) AS area, area_name, CAST(rpt_dist_no AS INTEGER) AS rpt_dist_no,
    CAST(crm_cd AS INTEGER) AS crm_cd, crm_cd_desc, mocodes,
    CAST(vict_age AS INTEGER) AS vict_age,
    CASE vict_sex WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' WHEN 'X' THEN 'Unknown' END AS vict_sex,
    vict_descent, CAST(premis_cd AS INTEGER) AS premis_cd, premis_desc,
    CAST(weapon_used_cd AS INTEGER) AS weapon_used_cd, weapon_desc, status, status_desc,
    CAST(crm_cd_1 AS INTEGER) AS crm_cd_1, CAST(crm_cd_2 AS INTEGER) AS crm_cd_2,
    CAST(crm_cd_3 AS INTEGER) AS crm_cd_3, CAST(crm_cd_4 AS INTEGER) AS crm_cd_4,
    location, cross_street, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, dl_upd{extra}
  FROM {src}"""

STG = f"stg AS ({STG_SELECT.format(src='raw', extra='')})"

SEEDS = (f"descent AS (SELECT descent_code, descent_description FROM read_csv('{SEED_DIR}/descent_mapping.csv', "
         "header = true, all_varchar = true)),\n"
         f"moseed AS (SELECT CAST(mocodes AS INTEGER) AS code, description FROM read_csv('{SEED_DIR}/mocodes.csv', "
         "header = true, all_varchar = true, quote = '\"', escape = '\"') WHERE mocodes IS NOT NULL)")


def latest_dim(name: str, code: str, label: str, label_as: str, where: str = "TRUE",
               src: str = "stg", ts: str = RUN_TS) -> str:
    return f"""{name} AS (
  SELECT {md5_key('code')} AS id, code, {label_as}, source_dlu, {ts} AS dlu FROM (
    SELECT {code} AS code, {label} AS {label_as}, dl_upd AS source_dlu,
           row_number() OVER (PARTITION BY {code} ORDER BY dl_upd DESC NULLS LAST,
                              {label} DESC NULLS LAST) AS rn
    FROM {src} WHERE {where}) WHERE rn = 1)"""


DIMS = ",\n".join([
    latest_dim("dim_area", "area", "area_name", "name"),
    latest_dim("dim_status", "status", "status_desc", "description", "status IS NOT NULL"),
    latest_dim("dim_premise", "premis_cd", "premis_desc", "description",
               "premis_cd IS NOT NULL AND premis_desc IS NOT NULL"),
    latest_dim("dim_weapon", "weapon_used_cd", "weapon_desc", "description", "weapon_used_cd IS NOT NULL"),
    latest_dim("dim_crime_code", "crm_cd", "crm_cd_desc", "description"),
])

CODES = """codes AS (
  SELECT DISTINCT dr_no, code FROM (
    SELECT dr_no, unnest([crm_cd_1, crm_cd_2, crm_cd_3, crm_cd_4]) AS code FROM stg)
  WHERE code IS NOT NULL)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (RAW, STG, SEEDS, DIMS)


def fact_sql(stg: str = "stg", doe: str = RUN_TS, dlu: str = RUN_TS, since: str = "dl_upd") -> str:
    in_range = "{d} >= " + DATE_LO + " AND {d} < " + DATE_HI
    return f"""
SELECT s.dr_no,
  CASE WHEN {in_range.format(d='s.date_rptd')} THEN {md5_key('s.date_rptd')} END AS date_rptd_id,
  CASE WHEN {in_range.format(d='s.date_occ')} THEN {md5_key('s.date_occ')} END AS date_occ_id,
  {md5_key('s.hour_occ', 's.minute_occ')} AS time_occ_id,
  CASE WHEN s.vict_descent IS NULL OR d.descent_code IS NOT NULL
       THEN {md5_key('s.vict_age', 's.vict_sex', 'd.descent_description')} END AS victims_id,
  CASE WHEN s.weapon_used_cd IS NOT NULL THEN {md5_key('s.weapon_used_cd')} END AS weapons_id,
  CASE WHEN s.status IS NOT NULL THEN {md5_key('s.status')} END AS status_dim_id,
  {md5_key('s.area')} AS area_dim_id,
  CASE WHEN p.code IS NOT NULL THEN {md5_key('s.premis_cd')} END AS premis_dim_id,
  {md5_key('s.location', 's.cross_street', dec('s.lat'), dec('s.lon'))} AS location_dim_id,
  {doe} AS doe, {dlu} AS dlu
FROM {stg} s
LEFT JOIN descent d ON s.vict_descent = d.descent_code
LEFT JOIN (SELECT premis_cd AS code, min({since}) AS since FROM {stg}
           WHERE premis_cd IS NOT NULL AND premis_desc IS NOT NULL GROUP BY 1) p ON s.premis_cd = p.code"""


BRIDGE_CRIME = f"""
SELECT c.dr_no, {md5_key('c.code')} AS crime_code_dim_id, {RUN_TS} AS doe, {RUN_TS} AS dlu
FROM codes c JOIN dim_crime_code dc ON c.code = dc.code"""

MO = """mo AS (
  SELECT DISTINCT dr_no, TRY_CAST(tok AS INTEGER) AS code FROM (
    SELECT dr_no, unnest(regexp_split_to_array(trim(mocodes), ' +')) AS tok
    FROM stg WHERE mocodes IS NOT NULL))"""

BRIDGE_MO = f"""
SELECT mo.dr_no, {md5_key('m.code')} AS mocode_dim_id, {RUN_TS} AS doe, {RUN_TS} AS dlu
FROM mo JOIN moseed m ON mo.code = m.code"""

VICTIM_DIM = f"""dim_victim AS (
  SELECT {md5_key('age', 'sex', 'descent')} AS id, age, sex, descent, max(dl_upd) AS source_dlu,
         {RUN_TS} AS dlu
  FROM (SELECT s.vict_age AS age, s.vict_sex AS sex, d.descent_description AS descent, s.dl_upd
        FROM stg s LEFT JOIN descent d ON s.vict_descent = d.descent_code)
  GROUP BY age, sex, descent)"""

LOCATION_DIM = f"""dim_location AS (
  SELECT {md5_key('location', 'cross_street', dec('lat'), dec('lon'))} AS id,
         location, cross_street, lat, lon, max(dl_upd) AS source_dlu, {RUN_TS} AS dlu,
         {RUN_TS} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM stg GROUP BY location, cross_street, lat, lon)"""


def dim_date_sql(lo: str, hi_exclusive: str) -> str:
    d = "CAST(g.d AS DATE)"
    return f"""
SELECT {md5_key(d)} AS id, {d} AS full_date,
  CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month,
  upper(strftime({d}, '%b')) AS month_name, CAST(day({d}) AS INTEGER) AS day,
  CAST(dayofweek({d}) AS INTEGER) AS day_of_week, strftime({d}, '%A') AS day_name,
  CAST(weekofyear({d}) AS INTEGER) AS week_of_year, CAST(quarter({d}) AS INTEGER) AS quarter,
  dayofweek({d}) IN (0, 6) AS is_weekend, {RUN_TS} AS doe, {RUN_TS} AS dlu
FROM generate_series(CAST({lo} AS TIMESTAMP), CAST({hi_exclusive} AS TIMESTAMP) - INTERVAL 1 DAY,
                     INTERVAL 1 DAY) AS g(d)"""


def share_sql(inner: str, count: str, total: str, pct_col: str, part: str, cols: str) -> str:
    return f"""
SELECT {cols}, {count}, CAST(sum({count}) OVER (PARTITION BY {part}) AS BIGINT) AS {total},
  {pct(count, f'sum({count}) OVER (PARTITION BY {part})')} AS {pct_col}
FROM ({inner})"""


# Change feed as SQL: batch 2 re-sends every tenth batch-1 report with status
# AR; batch 3 re-sends batch-1 reports ending in 1 unchanged.
RESENT = f"(dl_upd = {S1} AND CAST(dr_no AS BIGINT) % 10 = 0)"
FEED = f"""feed AS (
  SELECT dr_no, status, dl_upd AS stamp FROM raw
  UNION ALL SELECT dr_no, 'AR', {S2} FROM raw WHERE {RESENT}
  UNION ALL SELECT dr_no, status, {S3} FROM raw WHERE dl_upd = {S1} AND CAST(dr_no AS BIGINT) % 10 = 1)"""

RAW_FINAL = (f"raw_final AS (SELECT * REPLACE (CASE WHEN {RESENT} THEN 'AR' ELSE status END AS status, "
             f"CASE WHEN {RESENT} THEN {S2} ELSE dl_upd END AS dl_upd, "
             f"CASE WHEN dl_upd > {S1} AND CAST(dr_no AS BIGINT) % 41 = 0 THEN NULL ELSE crm_cd END AS crm_cd), "
             "dl_upd AS first_stamp FROM raw)")


REPORT_ORDER = {
    "area_monthly_summary": ["area_code", "area_name", "year", "month"],
    "crime_code_seasonality": ["crime_code", "month_number"],
    "location_density": ["lat_bucket", "lon_bucket", "crime_code", "year", "month_number", "time_of_day"],
    "victim_demographics": ["victim_age", "victim_sex", "victim_descent"],
    "weapon_distribution": ["area_name", "part_of_day", "weapon_type"],
}

# The moved feed after its three batches: every tenth batch-1 report has moved
# once, every twentieth twice.
_MOVED = f"(dl_upd = {S1} AND CAST(dr_no AS BIGINT) % 10 = 0)"
_AGAIN = f"(dl_upd = {S1} AND CAST(dr_no AS BIGINT) % 20 = 0)"


def _moved(column: str, once: str, twice: str | None = None) -> str:
    return f"CASE WHEN {_AGAIN} THEN {twice or once} WHEN {_MOVED} THEN {once} ELSE {column} END AS {column}"


RAW_MOVED = RAW + f""",
raw_moved AS (SELECT * REPLACE (
  {_moved("area", "'98'", "'99'")}, {_moved("area_name", "'MOVED'", "'MOVED AGAIN'")},
  {_moved("date_occ", "'03/05/2024 12:00:00 AM'")}, {_moved("time_occ", "'2315'")},
  {_moved("weapon_used_cd", "NULL", "'200'")}, {_moved("weapon_desc", "NULL", "'WEAPON 200 V9'")},
  {_moved("vict_age", "'33'")}, {_moved("location", "'MOVED'")}, {_moved("lat", "'34.5000'")},
  {_moved("lon", "'-118.5000'")}, {_moved("dl_upd", S2, S3)}) FROM raw)"""


def report_sql(raw: str, name: str, load_ts: str) -> dict[str, str]:
    """The five reports over the raw rows ``name`` that the CTEs ``raw`` define."""
    q: dict[str, str] = {}
    ctes = (raw, f"stg AS ({STG_SELECT.format(src=name, extra='')})", SEEDS, DIMS)
    base, base_codes = with_(*ctes), with_(*ctes, CODES)
    in_range = f"s.date_occ >= {DATE_LO} AND s.date_occ < {DATE_HI}"
    q["area_monthly_summary"] = base + f"""
SELECT s.area AS area_code, a.name AS area_name,
  CASE WHEN {in_range} THEN CAST(year(s.date_occ) AS INTEGER) END AS year,
  CASE WHEN {in_range} THEN CAST(month(s.date_occ) AS INTEGER) END AS month,
  count(*) AS crime_count, {load_ts} AS dlu
FROM stg s LEFT JOIN dim_area a ON s.area = a.code GROUP BY 1, 2, 3, 4"""
    q["crime_code_seasonality"] = base_codes + share_sql(
        f"""SELECT c.code AS crime_code, dc.description AS crime_description,
                   upper(strftime(s.date_occ, '%b')) AS month,
                   CAST(month(s.date_occ) AS INTEGER) AS month_number, count(*) AS crime_count
            FROM stg s JOIN codes c ON s.dr_no = c.dr_no JOIN dim_crime_code dc ON c.code = dc.code
            WHERE {in_range} GROUP BY 1, 2, 3, 4""",
        "crime_count", "total_by_crime", "month_percentage", "crime_code",
        "crime_code, crime_description, month, month_number")
    q["location_density"] = base_codes + share_sql(
        f"""SELECT {bucket('s.lat')} AS lat_bucket, {bucket('s.lon')} AS lon_bucket,
                   c.code AS crime_code, dc.description AS crime_description,
                   upper(strftime(s.date_occ, '%b')) AS month,
                   CAST(year(s.date_occ) AS INTEGER) AS year,
                   CAST(month(s.date_occ) AS INTEGER) AS month_number,
                   {PART_OF_DAY.format(h='s.hour_occ')} AS time_of_day, count(*) AS crime_count
            FROM stg s JOIN codes c ON s.dr_no = c.dr_no JOIN dim_crime_code dc ON c.code = dc.code
            WHERE {in_range} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
        "crime_count", "total_crimes_in_grid", "crime_density_percentage", "lat_bucket, lon_bucket",
        "lat_bucket, lon_bucket, crime_code, crime_description, month, year, month_number, time_of_day")
    q["victim_demographics"] = base + share_sql(
        """SELECT s.vict_age AS victim_age, s.vict_sex AS victim_sex,
                  d.descent_description AS victim_descent, count(*) AS incident_count
           FROM stg s LEFT JOIN descent d ON s.vict_descent = d.descent_code
           WHERE s.vict_descent IS NULL OR d.descent_code IS NOT NULL GROUP BY 1, 2, 3""",
        "incident_count", "total_by_age_sex", "descent_percentage", "victim_age, victim_sex",
        "victim_age, victim_sex, victim_descent")
    q["weapon_distribution"] = base + share_sql(
        f"""SELECT a.name AS area_name, {PART_OF_DAY.format(h='s.hour_occ')} AS part_of_day,
                   w.description AS weapon_type, count(*) AS weapon_count
            FROM stg s JOIN dim_area a ON s.area = a.code JOIN dim_weapon w ON s.weapon_used_cd = w.code
            GROUP BY 1, 2, 3""",
        "weapon_count", "total_crimes", "weapon_type_percentage", "area_name, part_of_day",
        "area_name, part_of_day, weapon_type")

    return q


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_(*BASE)
    q["stg_incidents"] = with_(RAW) + "SELECT * FROM (" + STG_SELECT.format(src='raw', extra='') + ")"
    q["landing_csv_scan"] = with_(RAW) + f"SELECT * EXCLUDE (dl_upd), {RUN_TS} AS dl_upd FROM raw"
    q["dim_area"] = base + "SELECT * FROM dim_area"
    q["dim_status"] = base + "SELECT * FROM dim_status"
    q["dim_premise"] = base + "SELECT * FROM dim_premise"
    q["dim_weapon"] = base + "SELECT * FROM dim_weapon"
    q["dim_crime_code"] = base + "SELECT * FROM dim_crime_code"
    q["dim_victim"] = with_(*BASE, VICTIM_DIM) + "SELECT * FROM dim_victim"
    q["dim_location_snapshot"] = with_(*BASE, LOCATION_DIM) + "SELECT * FROM dim_location"
    q["dim_date_coverage"] = (with_(*BASE) + dim_date_sql(
        "(SELECT min(date_occ) FROM stg)", "(SELECT max(date_rptd) FROM stg) + 1"))
    q["bridge_crime_code"] = with_(*BASE, CODES) + BRIDGE_CRIME
    q["bridge_mocode"] = with_(*BASE, MO) + BRIDGE_MO
    q["fct_incidents_full"] = base + fact_sql()
    stg_final = f"stg_final AS ({STG_SELECT.format(src='raw_final', extra=', first_stamp')})"
    q["fct_incidents_3batch"] = (with_(*BASE, RAW_FINAL, stg_final)
                                 + fact_sql("stg_final", "s.first_stamp",
                                            "greatest(s.dl_upd, coalesce(p.since, s.dl_upd))", "first_stamp"))
    # A bridge row appears when both its report and its code have been loaded.
    q["bridge_crime_code_3batch"] = with_(*BASE, RAW_FINAL, stg_final) + f"""
SELECT c.dr_no, {md5_key('c.code')} AS crime_code_dim_id, greatest(c.first_stamp, k.since) AS doe,
       greatest(c.dl_upd, k.since) AS dlu
FROM (SELECT DISTINCT dr_no, code, first_stamp, dl_upd FROM (
        SELECT dr_no, first_stamp, dl_upd, unnest([crm_cd_1, crm_cd_2, crm_cd_3, crm_cd_4]) AS code
        FROM stg_final)) c
JOIN (SELECT crm_cd AS code, min(first_stamp) AS since FROM stg_final
      WHERE crm_cd IS NOT NULL GROUP BY 1) k ON c.code = k.code"""
    q["dim_crime_code_3batch"] = with_(*BASE, RAW_FINAL, stg_final, latest_dim(
        "final", "crm_cd", "crm_cd_desc", "description", src="stg_final", ts="source_dlu")) + "SELECT * FROM final"
    q["fct_incidents_same_stamp"] = base + fact_sql()
    q["raw_merge_upsert"] = with_(RAW, RAW_FINAL) + "SELECT * EXCLUDE (first_stamp) FROM raw_final"
    q["merge_update_columns_subset"] = with_(RAW) + f"""
SELECT dr_no, CASE WHEN CAST(dr_no AS BIGINT) % 10 = 0 THEN 'AR' ELSE status END AS status,
       status_desc, weapon_desc, dl_upd,
       CASE WHEN CAST(dr_no AS BIGINT) % 10 = 1 THEN 'unchanged' ELSE 'keep' END AS _action
FROM raw WHERE dl_upd = {S1}
UNION ALL
SELECT dr_no, status, status_desc, weapon_desc, dl_upd,
       CASE WHEN dl_upd = {S2} THEN 'keep' ELSE 'insert' END FROM raw WHERE dl_upd > {S1}"""
    q["merge_schema_sync"] = with_(RAW) + f"""
SELECT dr_no, CASE WHEN m THEN 'AR' ELSE status END AS status,
       CASE WHEN m OR late THEN status_desc END AS status_desc,
       CASE WHEN m THEN {S2} WHEN late THEN {S3} ELSE dl_upd END AS dl_upd
FROM (SELECT *, CAST(dr_no AS BIGINT) % 10 = 0 AS m, CAST(dr_no AS BIGINT) % 10 = 1 AS late
      FROM raw WHERE dl_upd = {S1})
UNION ALL
SELECT dr_no, status, status_desc, dl_upd FROM raw WHERE dl_upd > {S1}"""
    q["since_watermark_weapons"] = with_(
        *BASE[:3],
        latest_dim("inc", "weapon_used_cd", "weapon_desc", "description",
                   f"weapon_used_cd IS NOT NULL AND dl_upd > (SELECT max(dl_upd) FROM stg "
                   f"WHERE dl_upd <= {S1} AND weapon_used_cd IS NOT NULL)")) + "SELECT * FROM inc"
    q["first_seen_carry"] = with_(RAW, FEED) + \
        "SELECT dr_no, min(stamp) AS doe, max(stamp) AS dlu FROM feed GROUP BY dr_no"
    q["snapshot_status_history"] = with_(RAW, FEED) + """
SELECT dr_no, status, stamp AS valid_from,
       lead(stamp) OVER (PARTITION BY dr_no ORDER BY stamp) AS valid_to
FROM (SELECT CAST(dr_no AS BIGINT) AS dr_no, status, stamp,
             lag(status) OVER (PARTITION BY dr_no ORDER BY stamp) AS prev,
             row_number() OVER (PARTITION BY dr_no ORDER BY stamp) AS rn
      FROM feed)
WHERE rn = 1 OR status IS DISTINCT FROM prev"""
    q["status_history_one_pass"] = q["snapshot_status_history"]
    q["snapshot_status_table"] = q["snapshot_status_history"]
    q["first_seen_one_pass"] = q["first_seen_carry"]
    q["landing_quarantine"] = with_(RAW) + """
SELECT dr_no, CASE WHEN reasons IS NULL THEN date_occ END AS date_occ, CASE WHEN reasons IS NULL THEN area END AS area,
       CASE WHEN reasons IS NULL THEN lat END AS lat, reasons
FROM (SELECT *, CASE WHEN CAST(dr_no AS BIGINT) % 71 = 0 OR CAST(dr_no AS BIGINT) % 73 = 0 THEN 'malformed record'
                     ELSE nullif(concat_ws('; ',
                       CASE WHEN CAST(dr_no AS BIGINT) % 61 = 0 THEN 'date_occ: not a date' END,
                       CASE WHEN CAST(dr_no AS BIGINT) % 67 = 0 THEN 'time_occ: not a time of day' END,
                       CASE WHEN CAST(dr_no AS BIGINT) % 83 = 0 THEN 'area: not an integer' END,
                       CASE WHEN CAST(dr_no AS BIGINT) % 79 = 0 THEN 'lat: not a number' END), '') END AS reasons
      FROM raw)"""
    q["orders_share_by_priority"] = share_sql(
        """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
                  CAST(month(o_orderdate) AS INTEGER) AS order_month, o_orderpriority,
                  count(*) AS order_count
           FROM orders GROUP BY 1, 2, 3""",
        "order_count", "month_total", "priority_share", "order_year, order_month",
        "order_year, order_month, o_orderpriority")
    q["customer_latest_order"] = """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
    o_orderkey DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderstatus DESC NULLS LAST) AS rn
  FROM orders) WHERE rn = 1"""
    q["location_grid_counts"] = with_(RAW, STG) + f"""
SELECT {bucket('lat')} AS lat_bucket, {bucket('lon')} AS lon_bucket, count(*) AS incident_count
FROM stg GROUP BY 1, 2"""

    # Reports, from staged rows and code joins (no surrogate ids).
    q.update(report_sql(RAW, "raw", RUN_TS))
    for name, order in REPORT_ORDER.items():
        columns = ", ".join(f"{c} NULLS LAST" for c in order)
        q[f"{name}_positions"] = f"SELECT *, row_number() OVER (ORDER BY {columns}) - 1 AS position FROM ({q[name]})"
    q.update({f"{name}_by_deltas": sql for name, sql in report_sql(RAW_MOVED, "raw_moved", S3).items()})

    counts = [
        ("dim_date", f"SELECT count(*) FROM generate_series({DATE_LO}, {DATE_HI} - 1, INTERVAL 1 DAY)"),
        ("dim_time", "SELECT count(*) FROM range(24) h, range(60) m"),
        ("dim_mocode", "SELECT count(*) FROM moseed"),
        ("dim_area", "SELECT count(*) FROM dim_area"),
        ("dim_status", "SELECT count(*) FROM dim_status"),
        ("dim_premise", "SELECT count(*) FROM dim_premise"),
        ("dim_weapon", "SELECT count(*) FROM dim_weapon"),
        ("dim_crime_code", "SELECT count(*) FROM dim_crime_code"),
        ("dim_victim", "SELECT count(*) FROM dim_victim"),
        ("dim_location", "SELECT count(*) FROM dim_location"),
        ("bridge_crime_code", f"SELECT count(*) FROM ({BRIDGE_CRIME})"),
        ("bridge_mocode", f"SELECT count(*) FROM ({BRIDGE_MO})"),
        ("fct_incidents", "SELECT count(*) FROM stg"),
    ]
    q["pipeline_row_counts"] = with_(*BASE, VICTIM_DIM, LOCATION_DIM, CODES, MO) + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, CAST(({s}) AS BIGINT) AS row_count" for n, s in counts)
    q.update(check_oracles())
    return q


def _check_row(check: str, table: str, column: str, failures_sql: str) -> str:
    return (f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
            f"CAST(coalesce(({failures_sql}), 0) AS BIGINT) AS failures, "
            f"coalesce(({failures_sql}), 0) = 0 AS passed")


def check_oracles() -> dict[str, str]:
    from blotter.plans.queries import (FACT_FKS, FRESHNESS_NOW, NOT_NULL_COLS, REGEX_CHECKS,
                                       RELATIONSHIPS, UNIQUE_CHECKS)
    q: dict[str, str] = {}
    nn = [_check_row("not_null", "raw_incidents", c,
                     f"SELECT sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM raw")
          for c in NOT_NULL_COLS]
    un = [_check_row("unique", t, c,
                     f"SELECT count(*) FROM (SELECT {c} FROM {'raw' if t == 'raw_incidents' else t} "
                     f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
          for t, c in UNIQUE_CHECKS]
    rx = [_check_row("regex", "raw_incidents", c,
                     f"SELECT sum(CASE WHEN {c} IS NOT NULL AND NOT regexp_matches({c}, '{p}') "
                     f"THEN 1 ELSE 0 END) FROM raw") for c, p in REGEX_CHECKS.items()]
    q["check_not_null"] = with_(RAW) + "\nUNION ALL\n".join(nn)
    q["check_unique"] = with_(RAW) + "\nUNION ALL\n".join(un)
    q["check_regex"] = with_(RAW) + "\nUNION ALL\n".join(rx)
    q["check_summary"] = with_(RAW, "checks AS (" + "\nUNION ALL\n".join(nn + un + rx) + ")") + """
SELECT "table", count(*) AS checks, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed_checks,
       CAST(sum(CASE WHEN passed THEN 0 ELSE 1 END) AS BIGINT) AS failed_checks,
       CAST(sum(failures) AS BIGINT) AS failures
FROM checks GROUP BY 1"""
    q["check_relationship_lineitem_orders"] = "\nUNION ALL\n".join(
        _check_row(f"relationship:{pt}.{pk}", ct, fk,
                   f"SELECT count(*) FROM {ct} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {pt} p WHERE p.{pk} = c.{fk})")
        for ct, fk, pt, pk in RELATIONSHIPS)
    dim_ids = {
        "dim_date": f"SELECT {md5_key('CAST(g.d AS DATE)')} AS id FROM generate_series("
                    f"CAST({DATE_LO} AS TIMESTAMP), CAST({DATE_HI} AS TIMESTAMP) - INTERVAL 1 DAY, "
                    "INTERVAL 1 DAY) AS g(d)",
        "dim_time": f"SELECT {md5_key('h.range', 'm.range')} AS id FROM range(24) h, range(60) m",
    }
    ctes = [f"fact AS ({fact_sql()})"] + [f"ids_{k} AS ({v})" for k, v in dim_ids.items()]
    for d in ("dim_victim", "dim_weapon", "dim_status", "dim_area", "dim_premise", "dim_location"):
        ctes.append(f"ids_{d} AS (SELECT id FROM {d})")
    q["check_relationship_fact_dims"] = with_(*BASE, VICTIM_DIM, LOCATION_DIM, *ctes) + "\nUNION ALL\n".join(
        _check_row(f"relationship:{d}.id", "fct_incidents", fk,
                   f"SELECT count(*) FROM fact f WHERE f.{fk} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM ids_{d} p WHERE p.id = f.{fk})")
        for fk, d in FACT_FKS)
    q["source_freshness"] = with_(RAW) + f"""
SELECT max_loaded_at, age_hours,
  CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_hours > 48 THEN 'error'
       WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(dl_upd) AS max_loaded_at,
             date_diff('second', max(dl_upd), TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 AS age_hours FROM raw)"""
    zs = """
SELECT *, CASE WHEN train_n < 2 THEN false WHEN train_stddev_raw > 0 THEN abs(z_raw) > 3.0
               ELSE value <> train_mean_raw END AS is_anomaly,
       round(z_raw, 4) AS z_score, round(train_mean_raw, 4) AS train_mean,
       round(train_stddev_raw, 4) AS train_stddev
FROM (SELECT *, CASE WHEN train_n >= 2 AND train_stddev_raw > 0
                     THEN (value - train_mean_raw) / train_stddev_raw END AS z_raw
      FROM (SELECT {cols}, count(value) OVER w AS train_n, avg(value) OVER w AS train_mean_raw,
                   stddev_samp(value) OVER w AS train_stddev_raw
            FROM series WINDOW w AS ({part} ORDER BY bucket ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)))"""

    def z_sql(series: str, cols: str = "bucket, value", part: str = "") -> str:
        body = zs.format(cols=cols, part=part)
        return f"WITH series AS ({series})\nSELECT * EXCLUDE (z_raw, train_mean_raw, train_stddev_raw) FROM ({body})"

    q["volume_anomalies_daily"] = z_sql("""
SELECT CAST(g.d AS DATE) AS bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS value
FROM generate_series((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) FROM events),
                     INTERVAL 1 DAY) AS g(d)
LEFT JOIN (SELECT CAST(ts AS DATE) AS b, count(*) AS n FROM events GROUP BY 1) c ON c.b = CAST(g.d AS DATE)""")
    q["volume_anomalies_spike"] = z_sql("""
SELECT CAST(g.d AS DATE) AS bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS value
FROM generate_series((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) FROM events),
                     INTERVAL 1 DAY) AS g(d)
LEFT JOIN (SELECT CAST(ts AS DATE) AS b, sum(CASE WHEN day(ts) = 25 THEN 10 ELSE 1 END) AS n
           FROM events GROUP BY 1) c ON c.b = CAST(g.d AS DATE)""")
    q["freshness_anomalies_gap"] = z_sql("""
SELECT CAST(ts AS DATE) AS bucket, max(gap) AS value FROM (
  SELECT ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts))) / 1e6 AS gap
  FROM (SELECT DISTINCT CASE WHEN day(ts) = 25 AND hour(ts) BETWEEN 3 AND 21
                             THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE CAST(ts AS TIMESTAMP) END AS ts
        FROM events WHERE ts IS NOT NULL))
WHERE gap IS NOT NULL GROUP BY 1""")
    bad_orders = ("(SELECT CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 97 = 0 "
                  "THEN o_custkey + 1000000000 ELSE o_custkey END AS k FROM orders)")
    bad_parts = "(SELECT CASE WHEN l_orderkey % 101 = 0 THEN -l_partkey ELSE l_partkey END AS k FROM lineitem)"
    q["check_seeded_orphans"] = "\nUNION ALL\n".join(
        _check_row(f"relationship:{pt}.{pk}", ct, fk,
                   f"SELECT count(*) FROM {src} c WHERE c.k IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {pt} p WHERE p.{pk} = c.k)")
        for ct, fk, src, pt, pk in [
            ("orders", "o_custkey", bad_orders, "customer", "c_custkey"),
            ("lineitem", "l_partkey", bad_parts, "part", "p_partkey"),
            ("lineitem", "l_suppkey", "(SELECT l_suppkey AS k FROM lineitem)", "supplier", "s_suppkey")])
    seeded = """seeded AS (SELECT CASE WHEN n % 31 = 0 THEN 'X' || mocodes ELSE mocodes END AS mocodes,
  CASE WHEN n % 53 = 0 THEN 'n/a' ELSE lat END AS lat, CASE WHEN n % 71 <> 0 THEN area END AS area
  FROM (SELECT *, CAST(dr_no AS BIGINT) AS n FROM raw))"""
    q["check_seeded_patterns"] = with_(RAW, seeded) + "\nUNION ALL\n".join(
        [_check_row("not_null", "raw_incidents", "area", "SELECT count(*) FROM seeded WHERE area IS NULL")]
        + [_check_row("regex", "raw_incidents", c, f"SELECT count(*) FROM seeded WHERE {c} IS NOT NULL "
                      f"AND NOT regexp_matches({c}, '{REGEX_CHECKS[c]}')") for c in ("mocodes", "lat")])
    q["freshness_anomalies_daily"] = z_sql("""
SELECT CAST(ts AS DATE) AS bucket, max(gap) AS value FROM (
  SELECT ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts))) / 1e6 AS gap
  FROM (SELECT DISTINCT ts FROM events WHERE ts IS NOT NULL))
WHERE gap IS NOT NULL GROUP BY 1""")
    metrics = {
        "null_count": "CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS DOUBLE)",
        "null_percent": "CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*) AS DOUBLE)",
        "min": "min(value)", "max": "max(value)", "average": "avg(value)",
        "standard_deviation": "stddev_samp(value)",
        "zero_count": "CAST(sum(CASE WHEN value = 0 THEN 1 ELSE 0 END) AS DOUBLE)",
    }
    def per_metric(table: str, col: str, ts: str) -> str:
        return "\nUNION ALL\n".join(
            f"SELECT CAST({ts} AS DATE) AS bucket, '{m}' AS metric, "
            f"round(CAST({e.replace('value', col)} AS DOUBLE), 6) AS value FROM {table} GROUP BY 1"
            for m, e in metrics.items())

    q["column_anomalies_value"] = z_sql(per_metric("events", "value", "ts"), "bucket, metric, value",
                                        "PARTITION BY metric")
    q["column_anomalies_victim_age"] = (
        with_(*BASE, VICTIM_DIM).rstrip("\n") + ",\n"
        + z_sql(per_metric("dim_victim", "age", "source_dlu"), "bucket, metric, value",
                "PARTITION BY metric")[len("WITH "):])
    q["freshness_anomalies_fact_dlu"] = (
        with_(RAW, RAW_FINAL).rstrip("\n") + ",\n"
        + z_sql("""
SELECT CAST(ts AS DATE) AS bucket, max(gap) AS value FROM (
  SELECT ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts))) / 1e6 AS gap
  FROM (SELECT DISTINCT dl_upd AS ts FROM raw_final WHERE dl_upd IS NOT NULL))
WHERE gap IS NOT NULL GROUP BY 1""")[len("WITH "):])
    stg_moved = f"stg AS ({STG_SELECT.format(src='raw_moved', extra='')})"
    found = ("SELECT {what}, bucket, CAST(value AS DOUBLE) AS value, "
             "CASE WHEN z_score = 0 THEN 0.0 ELSE z_score END AS z_score, coalesce(is_anomaly, false) AS is_anomaly "
             "FROM ({z})")
    volume = z_sql("""
SELECT CAST(g.d AS DATE) AS bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS value
FROM generate_series((SELECT min(date_occ) FROM stg), (SELECT max(date_occ) FROM stg), INTERVAL 1 DAY) AS g(d)
LEFT JOIN (SELECT date_occ AS b, count(*) AS n FROM stg GROUP BY 1) c ON c.b = CAST(g.d AS DATE)""")
    ages = z_sql(per_metric("stg", "vict_age", "date_occ"), "bucket, metric, value", "PARTITION BY metric")
    q["incident_anomalies_from_states"] = (
        with_(RAW_MOVED, stg_moved) + found.format(what="'volume' AS monitor, CAST(NULL AS VARCHAR) AS \"column\"", z=volume)
        + "\nUNION ALL\n" + found.format(what="'column' AS monitor, 'vict_age:' || metric AS \"column\"", z=ages))
    return q
