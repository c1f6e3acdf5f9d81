"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Models are built once per session and test-data folder into a scratch store
under ``spark.checkpoint.dir`` (the full build, and the three-batch
incremental replay), then every query reads those tables.
"""

from __future__ import annotations

import datetime as dt
import threading
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.checks import monitors as M
from blotter.checks import rules as C
from blotter.checks import states as S
from blotter.functions.share import grid_bucket, share_of_group
from blotter.operators.dedupe import latest_by
from blotter.operators.history import feed_history, feed_seen
from blotter.operators.incremental import high_watermark, ts_literal
from blotter.operators.joins import staged
from blotter.operators.merge import carry_first_seen, merge_upsert, sync_columns
from blotter.operators.snapshot import snapshot_check
from blotter.operators.position import with_position
from blotter.plans import pipeline as P
from blotter.plans import reports as R
from blotter.plans.dims import CODE_DIMS, code_dim, dim_date
from blotter.plans.staging import LOAD_SEQ, stg_incidents
from blotter.session import conform_session, scratch_path
from blotter.sources.fixture import BATCH_STAMPS, incident_fixture, read_table
from blotter.sources.landing import read_incidents_csv, split_landed, with_load_ts, write_landing_csv
from blotter.sources.snapshots import advance_snapshot
from blotter.sources.store import TableStore

# The load stamp of the one-shot build used by the queries.
RUN_TS = "2024-02-01 00:00:00"

_LOCK = threading.Lock()
_STARS: dict[tuple, P.Star] = {}


def _key(spark: SparkSession, sf_dir: str, kind: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)


def full_star(spark: SparkSession, sf_dir: str) -> P.Star:
    """The mart built in one run over the whole fixture (load stamp RUN_TS)."""
    conform_session(spark)
    k = _key(spark, sf_dir, "full")
    with _LOCK:
        if k not in _STARS:
            store = TableStore(spark, scratch_path(spark, "star-full"))
            P.load_raw(store, incident_fixture(spark, sf_dir))
            _STARS[k] = P.run_models(spark, store, RUN_TS)
        return _STARS[k]


def change_feed(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Three batches: each stamp's rows; batch 2 re-sends every tenth batch-1
    report with status ``AR``; batch 3 re-sends the batch-1 reports ending in
    1 unchanged (only the stamp differs)."""
    fx = incident_fixture(spark, sf_dir)
    s1, s2, s3 = (ts_literal(s) for s in BATCH_STAMPS)
    b1 = fx.filter(F.col("dl_upd") == s1)
    key_mod = F.col("dr_no").cast("long") % 10
    # Some reports of batches 2 and 3 have no primary code.
    no_code = F.when(F.col("dr_no").cast("long") % 41 != 0, F.col("crm_cd"))
    b2 = fx.filter(F.col("dl_upd") == s2).withColumn("crm_cd", no_code).unionByName(
        b1.filter(key_mod == 0).withColumn("status", F.lit("AR")).withColumn("dl_upd", s2))
    b3 = fx.filter(F.col("dl_upd") == s3).withColumn("crm_cd", no_code).unionByName(
        b1.filter(key_mod == 1).withColumn("dl_upd", s3))
    return list(zip(BATCH_STAMPS, [b1, b2, b3]))


def batch_star(spark: SparkSession, sf_dir: str) -> P.Star:
    """The mart advanced by three incremental runs over the change feed."""
    conform_session(spark)
    k = _key(spark, sf_dir, "3batch")
    with _LOCK:
        if k not in _STARS:
            store = TableStore(spark, scratch_path(spark, "star-3batch"))
            star = None
            for stamp, batch in change_feed(spark, sf_dir):
                P.load_raw(store, batch)
                star = P.run_models(spark, store, stamp)
            _STARS[k] = star
        return _STARS[k]


# -- models ----------------------------------------------------------------

def q_stg_incidents(spark, sf_dir):
    return stg_incidents(incident_fixture(spark, sf_dir))


def q_landing_csv_scan(spark, sf_dir):
    """Fixture text written as landing CSV, scanned back and stamped."""
    fx = incident_fixture(spark, sf_dir).drop("dl_upd")
    path = scratch_path(spark, "landing")
    write_landing_csv(fx, path)
    return with_load_ts(read_incidents_csv(spark, path), RUN_TS)


def q_pipeline_row_counts(spark, sf_dir):
    return P.row_counts(full_star(spark, sf_dir), P.CORE_TABLES)


def q_dim_date_coverage(spark, sf_dir):
    """Calendar rows spanning the staged incidents (first occurrence date to
    last report date, inclusive)."""
    stg = q_stg_incidents(spark, sf_dir)
    lo, hi = stg.agg(F.min("date_occ").alias("lo"), F.max("date_rptd").alias("hi")).first()
    return dim_date(spark, RUN_TS, lo, hi + dt.timedelta(days=1))


def _table(name):
    return lambda spark, sf_dir: full_star(spark, sf_dir).table(name)


def q_dim_location_snapshot(spark, sf_dir):
    return full_star(spark, sf_dir).table("dim_location")


def q_fct_incidents_3batch(spark, sf_dir):
    return batch_star(spark, sf_dir).table("fct_incidents")


def _batch_table(name):
    return lambda spark, sf_dir: batch_star(spark, sf_dir).table(name)


def q_fct_incidents_same_stamp(spark, sf_dir):
    """The fact after three loads of which two share a stamp and the last has
    an older one: every row arrives."""
    conform_session(spark)
    k = _key(spark, sf_dir, "same-stamp")
    with _LOCK:
        if k not in _STARS:
            store = TableStore(spark, scratch_path(spark, "star-same-stamp"))
            fx, third = incident_fixture(spark, sf_dir), F.col("dr_no").cast("long") % 3
            for part, stamp in ((0, BATCH_STAMPS[1]), (1, BATCH_STAMPS[1]), (2, BATCH_STAMPS[0])):
                P.load_raw(store, fx.filter(third == part).withColumn("dl_upd", ts_literal(stamp)))
                _STARS[k] = P.run_models(spark, store, RUN_TS)
        return _STARS[k].table("fct_incidents")


def moved_feed(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Three batches in which reports move: batch 2 re-sends every tenth
    batch-1 report with another area, time, victim age and place and without
    its weapon; batch 3 moves every second of those again."""
    fx = incident_fixture(spark, sf_dir)
    s1, s2, s3 = (ts_literal(s) for s in BATCH_STAMPS)
    n = F.col("dr_no").cast("long")
    none = F.lit(None).cast("string")
    moved = fx.filter((F.col("dl_upd") == s1) & (n % 10 == 0)).withColumns({
        "area": F.lit("98"), "area_name": F.lit("MOVED"), "date_occ": F.lit("03/05/2024 12:00:00 AM"),
        "time_occ": F.lit("2315"), "weapon_used_cd": none, "weapon_desc": none, "vict_age": F.lit("33"),
        "location": F.lit("MOVED"), "lat": F.lit("34.5000"), "lon": F.lit("-118.5000"), "dl_upd": s2})
    again = moved.filter(n % 20 == 0).withColumns({
        "area": F.lit("99"), "area_name": F.lit("MOVED AGAIN"), "weapon_used_cd": F.lit("200"),
        "weapon_desc": F.lit("WEAPON 200 V9"), "dl_upd": s3})
    return list(zip(BATCH_STAMPS, [fx.filter(F.col("dl_upd") == s1),
                                   fx.filter(F.col("dl_upd") == s2).unionByName(moved),
                                   fx.filter(F.col("dl_upd") == s3).unionByName(again)]))


def moved_star(spark: SparkSession, sf_dir: str) -> P.Star:
    """The mart and its reports advanced by three runs over the moved feed:
    the first counts all facts, the others only what their load changes."""
    conform_session(spark)
    k = _key(spark, sf_dir, "moved")
    with _LOCK:
        if k not in _STARS:
            store = TableStore(spark, scratch_path(spark, "star-moved"))
            star = None
            for stamp, batch in moved_feed(spark, sf_dir):
                P.load_raw(store, batch)
                star = P.run_models(spark, store, stamp, with_reports=True)
                S.incident_days(store)
            _STARS[k] = star
        return _STARS[k]


def _report_by_deltas(name):
    """A report as the third of three runs wrote it."""
    return lambda spark, sf_dir: moved_star(spark, sf_dir).table(name)


def _report_positions(name):
    """A report with the place of each row in the report's order."""
    return lambda spark, sf_dir: with_position(full_star(spark, sf_dir).report(name), R.report_order(name))


def q_raw_merge_upsert(spark, sf_dir):
    return batch_star(spark, sf_dir).table(P.RAW_TABLE).drop(LOAD_SEQ)


def _report(name):
    return lambda spark, sf_dir: full_star(spark, sf_dir).report(name)


# -- operators on their own ----------------------------------------------------

def q_merge_update_columns_subset(spark, sf_dir):
    """Batches 2 and 3 merged into batch 1 with only ``status`` updatable:
    matched rows take the new status but keep their old stamp and text.
    ``_action`` is that of the last merge."""
    cols = ["dr_no", "status", "status_desc", "weapon_desc", "dl_upd"]
    out = None
    for _, batch in change_feed(spark, sf_dir):
        target = out if out is None else staged(out.drop("_action"), "merge_target")[0]
        out = merge_upsert(target, batch.select(*cols), ["dr_no"], update_cols=["status"],
                           change_cols=["status"], with_action=True)
    return out


def q_merge_schema_sync(spark, sf_dir):
    """Target without ``status_desc``; the incoming batches 2 and 3 add it and
    drop ``weapon_desc``. Old rows get null in the new column."""
    (_, b1), (_, b2), (_, b3) = change_feed(spark, sf_dir)
    target = b1.select("dr_no", "status", "weapon_desc", "dl_upd")
    for batch in (b2, b3):
        incoming = batch.select("dr_no", "status", "status_desc", "dl_upd")
        merged = merge_upsert(sync_columns(target, incoming), incoming, ["dr_no"],
                              change_cols=["status", "status_desc"])
        target = staged(merged, "merge_target")[0]
    return target


def q_since_watermark_weapons(spark, sf_dir):
    """Weapon rows a second run merges: staged rows newer than the weapon
    table built from batch 1 (its max source stamp), latest label per code."""
    stg = q_stg_incidents(spark, sf_dir)
    first = code_dim(stg.filter(F.col("dl_upd") <= ts_literal(BATCH_STAMPS[0])),
                     CODE_DIMS["dim_weapon"], RUN_TS)
    wm = high_watermark(first, "source_dlu")
    return code_dim(stg, CODE_DIMS["dim_weapon"], RUN_TS, watermark=wm)


def q_first_seen_carry(spark, sf_dir):
    """Each report's first and last batch in the change feed, carried by
    ``carry_first_seen`` over three loads."""
    target = None
    for stamp, batch in change_feed(spark, sf_dir):
        inc = carry_first_seen(batch.select("dr_no"), target, ["dr_no"], stamp)
        target = merge_upsert(target, inc, ["dr_no"], update_cols=["dlu"], check_unique=False)
        target = target.checkpoint(eager=True)
    return target


def q_snapshot_status_history(spark, sf_dir):
    """Status history per report over the change feed (type-2 snapshot)."""
    snap = None
    for stamp, batch in change_feed(spark, sf_dir):
        incoming = batch.select(F.col("dr_no").cast("long").alias("dr_no"), "status")
        snap = snapshot_check(snap, incoming, "dr_no", ["status"], stamp).checkpoint(eager=True)
    return snap


def _whole_feed(spark, sf_dir, *cols) -> DataFrame:
    """The change feed as one frame, each row with the stamp of its load."""
    parts = [batch.select(*cols, ts_literal(stamp).alias("stamp")) for stamp, batch in change_feed(spark, sf_dir)]
    return reduce(DataFrame.unionByName, parts)


def q_status_history_one_pass(spark, sf_dir):
    """Status history per report over the whole change feed at once."""
    feed = _whole_feed(spark, sf_dir, F.col("dr_no").cast("long").alias("dr_no"), "status")
    return feed_history(feed, ["dr_no"], ["status"], "stamp")


def q_snapshot_status_table(spark, sf_dir):
    """The same history kept as a snapshot table over the three loads: each
    replaces the ranges of its keys only."""
    conform_session(spark)
    store = TableStore(spark, scratch_path(spark, "snapshot-status"))
    for number, (stamp, batch) in enumerate(change_feed(spark, sf_dir), 1):
        incoming = batch.select(F.col("dr_no").cast("long").alias("dr_no"), "status")
        advance_snapshot(store, "s", "status", incoming, ["dr_no"], ["status"], stamp, number)
    return store.read("s", "status")


def q_first_seen_one_pass(spark, sf_dir):
    return feed_seen(_whole_feed(spark, sf_dir, "dr_no"), ["dr_no"], "stamp")


def q_landing_quarantine(spark, sf_dir):
    """Landing files with seeded bad rows, split into good and rejected ones."""
    n = F.col("dr_no").cast("long")
    bad = {"date_occ": (61, "13/45/2024 12:00:00 AM"), "time_occ": (67, "2561"), "lat": (79, "n/a"), "area": (83, "x1")}
    fx = incident_fixture(spark, sf_dir).drop("dl_upd").withColumns(
        {c: F.when(n % every == 0, F.lit(text)).otherwise(F.col(c)) for c, (every, text) in bad.items()})
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in fx.columns])
    line = (F.when(n % 71 == 0, F.concat(line, F.lit(",one field more")))
            .when(n % 73 == 0, F.substring_index(line, ",", 9)).otherwise(line))
    path = scratch_path(spark, "landing-bad")
    # One text column whose name is the header line, written as it is.
    fx.select(line.alias(",".join(fx.columns))).write.option("header", True).option("sep", "\x01").csv(path)
    good, rejected = split_landed(read_incidents_csv(spark, path, keep_bad=True))
    none = F.lit(None).cast("string")
    return good.select("dr_no", "date_occ", "area", "lat", none.alias("reasons")).unionByName(
        rejected.select("dr_no", none.alias("date_occ"), none.alias("area"), none.alias("lat"),
                        F.array_join("reasons", "; ").alias("reasons")))


def q_orders_share_by_priority(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month"),
        "o_orderpriority")
    return share_of_group(o, ["order_year", "order_month", "o_orderpriority"],
                          ["order_year", "order_month"], "order_count", "month_total",
                          "priority_share")


def q_customer_latest_order(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "o_orderstatus")
    return latest_by(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def q_location_grid_counts(spark, sf_dir):
    stg = q_stg_incidents(spark, sf_dir)
    return (stg.select(grid_bucket("lat").alias("lat_bucket"), grid_bucket("lon").alias("lon_bucket"))
            .groupBy("lat_bucket", "lon_bucket").agg(F.count(F.lit(1)).alias("incident_count")))


def queries() -> dict:
    q = {
        "stg_incidents": q_stg_incidents,
        "landing_csv_scan": q_landing_csv_scan,
        "pipeline_row_counts": q_pipeline_row_counts,
        "dim_date_coverage": q_dim_date_coverage,
        "dim_area": _table("dim_area"),
        "dim_status": _table("dim_status"),
        "dim_premise": _table("dim_premise"),
        "dim_weapon": _table("dim_weapon"),
        "dim_crime_code": _table("dim_crime_code"),
        "dim_victim": _table("dim_victim"),
        "dim_location_snapshot": q_dim_location_snapshot,
        "bridge_crime_code": _table("bridge_crime_code"),
        "bridge_mocode": _table("bridge_mocode"),
        "fct_incidents_full": _table("fct_incidents"),
        "fct_incidents_3batch": q_fct_incidents_3batch,
        "fct_incidents_same_stamp": q_fct_incidents_same_stamp,
        "dim_crime_code_3batch": _batch_table("dim_crime_code"),
        "bridge_crime_code_3batch": _batch_table("bridge_crime_code"),
        "raw_merge_upsert": q_raw_merge_upsert,
        "merge_update_columns_subset": q_merge_update_columns_subset,
        "merge_schema_sync": q_merge_schema_sync,
        "since_watermark_weapons": q_since_watermark_weapons,
        "first_seen_carry": q_first_seen_carry,
        "snapshot_status_history": q_snapshot_status_history,
        "status_history_one_pass": q_status_history_one_pass,
        "first_seen_one_pass": q_first_seen_one_pass,
        "snapshot_status_table": q_snapshot_status_table,
        "landing_quarantine": q_landing_quarantine,
        "orders_share_by_priority": q_orders_share_by_priority,
        "customer_latest_order": q_customer_latest_order,
        "location_grid_counts": q_location_grid_counts,
    }
    for r in P.REPORTS:
        q[r] = _report(r)
        q[f"{r}_by_deltas"] = _report_by_deltas(r)
        q[f"{r}_positions"] = _report_positions(r)
    q.update(CHECK_QUERIES)
    return q


# -- data checks -----------------------------------------------------------------

# The checks each registered query runs.
NOT_NULL_COLS = ["dr_no", "date_rptd", "date_occ", "time_occ", "area", "vict_age", "vict_sex",
                 "vict_descent", "premis_cd", "weapon_used_cd", "mocodes", "cross_street", "lat", "lon"]
UNIQUE_CHECKS = [("raw_incidents", "dr_no"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"),
                 ("customer", "c_custkey"), ("customer", "c_nationkey")]
REGEX_CHECKS = {"dr_no": r"^\d+$", "mocodes": r"^\d{4}( \d{4})*$", "lat": r"^-?\d+\.\d+$"}
RELATIONSHIPS = [("lineitem", "l_orderkey", "orders", "o_orderkey"),
                 ("lineitem", "l_partkey", "part", "p_partkey"),
                 ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
                 ("orders", "o_custkey", "customer", "c_custkey"),
                 ("customer", "c_nationkey", "nation", "n_nationkey"),
                 ("events", "user_id", "customer", "c_custkey")]
FACT_FKS = [("date_occ_id", "dim_date"), ("date_rptd_id", "dim_date"), ("time_occ_id", "dim_time"),
            ("victims_id", "dim_victim"), ("weapons_id", "dim_weapon"), ("status_dim_id", "dim_status"),
            ("area_dim_id", "dim_area"), ("premis_dim_id", "dim_premise"),
            ("location_dim_id", "dim_location")]
FRESHNESS_NOW = "2024-02-01 12:00:00"


def _source(spark, sf_dir, name):
    return incident_fixture(spark, sf_dir) if name == "raw_incidents" else read_table(spark, sf_dir, name)


def q_check_not_null(spark, sf_dir):
    return C.check_not_null(incident_fixture(spark, sf_dir), "raw_incidents", NOT_NULL_COLS)


def q_check_unique(spark, sf_dir):
    by_table: dict[str, list[str]] = {}
    for t, c in UNIQUE_CHECKS:
        by_table.setdefault(t, []).append(c)
    return C.union_all([C.check_unique(_source(spark, sf_dir, t), t, cols) for t, cols in by_table.items()])


def q_check_regex(spark, sf_dir):
    return C.check_columns(incident_fixture(spark, sf_dir), "raw_incidents", regex=REGEX_CHECKS)


def q_check_relationship_lineitem_orders(spark, sf_dir):
    by_child: dict[str, list] = {}
    for ct, fk, pt, pk in RELATIONSHIPS:
        by_child.setdefault(ct, []).append((fk, read_table(spark, sf_dir, pt), pk, pt))
    return C.union_all([C.check_relationships(read_table(spark, sf_dir, ct), ct, links)
                        for ct, links in by_child.items()])


def q_check_relationship_fact_dims(spark, sf_dir):
    """All nine foreign keys of the fact in one scan of the fact."""
    star = full_star(spark, sf_dir)
    return C.check_relationships(star.table("fct_incidents"), "fct_incidents",
                                 [(fk, star.table(dim), "id", dim) for fk, dim in FACT_FKS])


def q_check_summary(spark, sf_dir):
    return C.summarise_checks(C.union_all([
        q_check_not_null(spark, sf_dir), q_check_unique(spark, sf_dir), q_check_regex(spark, sf_dir)]))


def q_source_freshness(spark, sf_dir):
    return M.source_freshness(incident_fixture(spark, sf_dir), "dl_upd", FRESHNESS_NOW)


def q_volume_anomalies_daily(spark, sf_dir):
    return M.volume_anomalies(read_table(spark, sf_dir, "events"), "ts")


def q_freshness_anomalies_daily(spark, sf_dir):
    return M.freshness_anomalies(read_table(spark, sf_dir, "events"), "ts")


def q_column_anomalies_value(spark, sf_dir):
    return M.column_anomalies(read_table(spark, sf_dir, "events"), "value", "ts")


def q_freshness_anomalies_fact_dlu(spark, sf_dir):
    """Freshness monitor on the incrementally loaded fact's update stamps."""
    return M.freshness_anomalies(batch_star(spark, sf_dir).table("fct_incidents"), "dlu")


def q_column_anomalies_victim_age(spark, sf_dir):
    """Column monitor on the victim dimension's age, per day of source stamp."""
    return M.column_anomalies(full_star(spark, sf_dir).table("dim_victim"), "age", "source_dlu")


def q_incident_anomalies_from_states(spark, sf_dir):
    """Volume and victim-age monitors per day of occurrence, from states kept
    over three loads in which reports also move to another day."""
    return S.incident_findings(S.incident_days(moved_star(spark, sf_dir).store))


# -- checks over seeded defects: the right answer is not "no failures" ---------

SEEDED_REGEX = {"mocodes": REGEX_CHECKS["mocodes"], "lat": REGEX_CHECKS["lat"]}


def q_check_seeded_orphans(spark, sf_dir):
    """Orders with customers that do not exist, line items with unknown parts."""
    orders = read_table(spark, sf_dir, "orders").withColumn("o_custkey", F.expr(
        "CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN o_custkey + 1000000000 "
        "ELSE o_custkey END"))
    items = read_table(spark, sf_dir, "lineitem").withColumn("l_partkey", F.expr(
        "CASE WHEN l_orderkey % 101 = 0 THEN -l_partkey ELSE l_partkey END"))
    return C.union_all([
        C.check_relationships(orders, "orders", [("o_custkey", read_table(spark, sf_dir, "customer"), "c_custkey",
                                                  "customer")]),
        C.check_relationships(items, "lineitem", [("l_partkey", read_table(spark, sf_dir, "part"), "p_partkey",
                                                   "part"),
                                                  ("l_suppkey", read_table(spark, sf_dir, "supplier"), "s_suppkey",
                                                   "supplier")])])


def q_check_seeded_patterns(spark, sf_dir):
    """Malformed code lists and coordinates, missing areas."""
    raw = incident_fixture(spark, sf_dir)
    n = F.col("dr_no").cast("long")
    raw = (raw.withColumn("mocodes", F.when(n % 31 == 0, F.concat(F.lit("X"), F.col("mocodes"))).otherwise(F.col("mocodes")))
           .withColumn("lat", F.when(n % 53 == 0, F.lit("n/a")).otherwise(F.col("lat")))
           .withColumn("area", F.when(n % 71 != 0, F.col("area"))))
    return C.check_columns(raw, "raw_incidents", not_null=["area"], regex=SEEDED_REGEX)


def q_volume_anomalies_spike(spark, sf_dir):
    """Every event of the 25th arrives ten times."""
    events = read_table(spark, sf_dir, "events").select("ts", F.explode(F.when(
        F.dayofmonth("ts") == 25, F.sequence(F.lit(1), F.lit(10))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return M.volume_anomalies(events, "ts")


def q_freshness_anomalies_gap(spark, sf_dir):
    """Updates between 3 and 22 o'clock of the 25th are stamped at midnight."""
    late = (F.dayofmonth("ts") == 25) & F.hour("ts").between(3, 21)
    events = read_table(spark, sf_dir, "events").withColumn(
        "ts", F.when(late, F.date_trunc("day", "ts").cast("timestamp_ntz")).otherwise(F.col("ts").cast("timestamp_ntz")))
    return M.freshness_anomalies(events, "ts")


CHECK_QUERIES = {
    "incident_anomalies_from_states": q_incident_anomalies_from_states,
    "check_seeded_orphans": q_check_seeded_orphans,
    "check_seeded_patterns": q_check_seeded_patterns,
    "volume_anomalies_spike": q_volume_anomalies_spike,
    "freshness_anomalies_gap": q_freshness_anomalies_gap,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_regex": q_check_regex,
    "check_relationship_lineitem_orders": q_check_relationship_lineitem_orders,
    "check_relationship_fact_dims": q_check_relationship_fact_dims,
    "check_summary": q_check_summary,
    "source_freshness": q_source_freshness,
    "volume_anomalies_daily": q_volume_anomalies_daily,
    "freshness_anomalies_daily": q_freshness_anomalies_daily,
    "column_anomalies_value": q_column_anomalies_value,
    "freshness_anomalies_fact_dlu": q_freshness_anomalies_fact_dlu,
    "column_anomalies_victim_age": q_column_anomalies_victim_age,
}
