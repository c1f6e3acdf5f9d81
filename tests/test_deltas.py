"""Change sets of the merges, reports kept by deltas, monitors from states."""

import pytest
from pyspark.sql import functions as F

from blotter.checks import monitors as M
from blotter.checks import states as S
from blotter.operators import counts as CO
from blotter.operators.position import with_position
from blotter.plans import deltas as D
from blotter.plans import pipeline as P
from blotter.plans.bridges import bridge_crime_code, bridge_mocode
from blotter.plans.fact import fct_incidents
from blotter.plans.queries import RUN_TS, change_feed, moved_feed, moved_star
from blotter.session import scratch_path
from blotter.sources.fixture import incident_fixture
from blotter.sources.seeds import load_seed
from blotter.sources.store import PART, TableStore

STAMPS = {"doe", "dlu", "source_dlu", "valid_from", "valid_to"}


def content(df, but=STAMPS):
    cols = sorted(c for c in df.columns if c not in but)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


def plan(df):
    return df._jdf.queryExecution().toString()


# -- change sets -----------------------------------------------------------------

@pytest.fixture(scope="module")
def small_load(spark, sf_small):
    """A mart, then a load of 99 known reports without a new code."""
    store = TableStore(spark, scratch_path(spark, "no-new-code"), buckets=2, part_width=100)
    fx = incident_fixture(spark, sf_small)
    P.load_raw(store, fx)
    P.run_models(spark, store, RUN_TS, with_reports=True)
    S.incident_days(store)
    P.load_raw(store, fx.filter(F.col("dr_no").cast("long").between(200, 299)).withColumn("status", F.lit("AR")))
    return store


def test_load_without_new_codes_scans_no_raw_rows(spark, small_load):
    store, upto = small_load, 2
    assert P.late_keys(store, "dim_crime_code", 1) is None and P.late_keys(store, "dim_premise", 1) is None
    fresh = P.loads_after(store, 1, upto)
    star = P.Star(store, RUN_TS, {n: store.rows(P.CORE, n) for n in P.CORE_TABLES})
    dims = {n: star.table(n) for n in P.CORE_TABLES if n.startswith("dim_")}
    increments = [
        bridge_crime_code(star.stg(), dims["dim_crime_code"], RUN_TS, 1, star.rows["dim_crime_code"], upto, fresh=fresh),
        bridge_mocode(star.stg(), dims["dim_mocode"], RUN_TS, 1, star.rows["dim_mocode"], upto, fresh=fresh),
        fct_incidents(star.stg(), dims, load_seed(spark, "descent_mapping"), RUN_TS, star.rows, 1, upto, fresh=fresh)]
    assert all("raw_incidents" not in plan(df) for df in increments)
    assert fresh.count() == 99
    assert store.parts_since(P.RAW, P.RAW_TABLE, 1) == [2]
    assert store.parts_since(P.RAW, P.RAW_TABLE, 0) is None


def test_inserted_keys_are_the_change_set(spark, sf_small):
    store = TableStore(spark, scratch_path(spark, "late-keys"))
    for stamp, batch in change_feed(spark, sf_small):
        P.load_raw(store, batch)
        star = P.run_models(spark, store, stamp)
    late = {n: sorted(r.code for r in P.late_keys(store, n, 2).collect()) for n in ("dim_crime_code", "dim_premise")}
    raw = star.stg()
    for name, code, label in (("dim_crime_code", "crm_cd", "crm_cd"), ("dim_premise", "premis_cd", "premis_desc")):
        first = raw.filter(F.col(label).isNotNull()).groupBy(code).agg(F.min("load_seq").alias("l"))
        assert late[name] == sorted(r[code] for r in first.filter("l = 3 AND %s IS NOT NULL" % code).collect()) != []
    assert P.late_keys(store, "dim_crime_code", 3) is None
    assert "first_load" not in star.table("dim_premise").columns


def test_new_codes_survive_a_run_that_failed_before_its_consumers(spark, sf_small, monkeypatch):
    store = TableStore(spark, scratch_path(spark, "failed-run"))
    feed = change_feed(spark, sf_small)
    for stamp, batch in feed[:2]:
        P.load_raw(store, batch)
        P.run_models(spark, store, stamp)
    P.load_raw(store, feed[2][1])
    merge = P._merge_live
    monkeypatch.setattr(P, "_merge_live", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        P.run_models(spark, store, feed[2][0])
    monkeypatch.setattr(P, "_merge_live", merge)
    star = P.run_models(spark, store, feed[2][0], with_reports=True)
    once = TableStore(spark, scratch_path(spark, "failed-run-once"))
    P.load_raw(once, star.table(P.RAW_TABLE).drop("load_seq"))
    whole = P.run_models(spark, once, RUN_TS)
    for name in ("fct_incidents", "bridge_crime_code", "bridge_mocode"):
        assert content(star.table(name)) == content(whole.table(name)), name


# -- reports by deltas ------------------------------------------------------------

def _same_reports(star):
    for name in P.REPORTS:
        assert content(star.table(name), {"dlu"}) == content(star.report(name), {"dlu"}) != [], name


def test_reports_by_deltas_equal_the_full_refresh(spark, sf_small):
    star = moved_star(spark, sf_small)
    _same_reports(star)
    fact, bridge = star.table("fct_incidents"), star.table("bridge_crime_code")
    whole = D.ReportDeltas(star.store, star, {D.FACT: None, D.BRIDGE: None}, {}, ("", ""))
    for name in D.KEYS:
        stored = star.store.read(D.STATE, name)
        assert stored.filter("n <= 0").count() == 0
        assert content(stored) == content(whole.counts(name, fact, bridge)), name


def test_deltas_read_only_the_partitions_of_the_load(spark, small_load):
    store = small_load
    star = P.Star(store, RUN_TS, {n: store.rows(P.CORE, n) for n in P.CORE_TABLES})
    marks = {n: store.watermark(P.CORE, n) for n in P.LIVE_MODELS}
    inc = store.read(P.CORE, "fct_incidents").filter("dr_no BETWEEN 200 AND 299")
    run = D.ReportDeltas(store, star, marks, {D.FACT: inc, D.BRIDGE: inc.select("dr_no")}, (P.DATE_START, P.DATE_END))
    assert run.advance
    run.before_merge(2)
    assert run.parts == [2]
    for name in (D.FACT, D.BRIDGE):
        text = run._affected(name)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in text and "dr_part" in text.split("PartitionFilters")[1][:90]


def test_counts_left_behind_or_of_another_calendar_are_made_anew(spark, sf_small):
    store = TableStore(spark, scratch_path(spark, "left-behind"))
    feed = moved_feed(spark, sf_small)
    P.load_raw(store, feed[0][1])
    P.run_models(spark, store, feed[0][0], with_reports=True)
    P.load_raw(store, feed[1][1])
    P.run_models(spark, store, feed[1][0])                       # without reports: the counts stay at load 1
    assert store.watermark(D.STATE, "area_counts") == 1
    P.load_raw(store, feed[2][1])
    _same_reports(P.run_models(spark, store, feed[2][0], with_reports=True))
    P.load_raw(store, feed[0][1].filter("dr_no LIKE '%3'").withColumn("area", F.lit("5")))
    _same_reports(P.run_models(spark, store, RUN_TS, with_reports=True, date_range=("2023-01-01", "2026-12-31")))


def test_add_counts_plans_agree(spark, monkeypatch):
    state = spark.createDataFrame([("a", 1, 5), ("a", None, 2), (None, None, 7), ("b", 2, 1)], "x string, y int, n long")
    before = spark.createDataFrame([("a", 1, 2), (None, None, 7), ("b", 2, 1)], "x string, y int, n long")
    after = spark.createDataFrame([("a", 1, 2), ("a", None, 3), ("c", None, 4)], "x string, y int, n long")
    delta = CO.signed(before, after, ["x", "y"])
    want = {("a", 1): 5, ("a", None): 5, ("c", None): 4}
    small = {(r.x, r.y): r.n for r in CO.add_counts(state, delta, ["x", "y"], 4).collect()}
    large = {(r.x, r.y): r.n for r in CO.add_counts(state, delta, ["x", "y"], 10 ** 12).collect()}
    assert small == large == want


# -- monitors from states ---------------------------------------------------------

def test_states_give_what_a_scan_gives(spark, sf_small):
    star = moved_star(spark, sf_small)
    states = S.incident_days(star.store)
    assert states.select(PART).distinct().count() >= 1
    stg = star.stg()
    volume = M.volume_anomalies(stg, "date_occ")
    column = M.column_anomalies(stg, "vict_age", "date_occ")
    found = S.incident_findings(states)
    zero = F.when(F.col("z_score") == 0, 0.0).otherwise(F.col("z_score")).alias("z_score")
    pick = lambda df: sorted(map(str, df.select("bucket", F.round(F.col("value").cast("double"), 4).alias("value"), zero, "is_anomaly").collect()))
    assert pick(found.filter("monitor = 'volume'")) == pick(volume)
    assert pick(found.filter("monitor = 'column'")) == pick(column)
    assert found.filter("is_anomaly").count() > 0


def test_states_read_only_replaced_partitions(spark, small_load):
    store, seen = small_load, []
    def make(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows.select(PART, "dl_upd").distinct()
    S.advance_state(store, "probe", P.RAW, P.RAW_TABLE, make)
    assert "dr_part" not in seen[0].split("PartitionFilters")[1][:90]
    n = store.read(S.STATE, "probe").count()
    store.write(store.read(S.STATE, "probe"), S.STATE, "probe", watermark=1)
    S.advance_state(store, "probe", P.RAW, P.RAW_TABLE, make)
    assert "dr_part" in seen[1].split("PartitionFilters")[1][:90]
    assert store.read(S.STATE, "probe").count() == n
    S.advance_state(store, "probe", P.RAW, P.RAW_TABLE, make)
    assert len(seen) == 2                                     # nothing new: nothing read


def test_states_merge_over_any_split(spark):
    df = spark.range(500).select(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id % 40)").alias("ts"),
                                 F.expr("CASE WHEN id % 7 > 0 THEN cast(id * id % 13 AS int) END").alias("v"), (F.col("id") % 3).alias("load"))
    parts = S.day_states(df.filter("load = 0"), "ts", ["v"])
    for k in (1, 2):
        parts = parts.unionByName(S.day_states(df.filter(f"load = {k}"), "ts", ["v"]))
    rounded = lambda m: sorted((str(r.bucket), r.metric, None if r.value is None else round(r.value, 6)) for r in m.collect())
    assert rounded(S.metric_series(parts, "v")) == rounded(M.column_metrics(df, "v", "ts"))
    assert content(S.volume_series(parts, "v")) == content(M.daily_volume(df, "ts"))


# -- positions --------------------------------------------------------------------

def test_positions_are_global_and_skip_nothing(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 9 > 0, F.col("id") * 7 % 1000).alias("k"), "id").repartition(7)
    got = with_position(df, [F.col("k").asc_nulls_last(), F.col("id")], partitions=5).orderBy("position").collect()
    want = sorted(((r.k is None, r.k or 0, r.id) for r in df.collect()))
    assert [(r.position, r.id) for r in got] == [(i, w[2]) for i, w in enumerate(want)]
    assert with_position(df.limit(0), [F.col("id")]).count() == 0


def test_affected_rows_are_looked_up_once_for_all_reports(spark, sf_small, monkeypatch):
    """Not once per count: facts and bridge before and after the merge."""
    looked, affected = [], D.ReportDeltas._affected
    monkeypatch.setattr(D.ReportDeltas, "_affected", lambda run, name: looked.append(plan(affected(run, name))) or affected(run, name))
    counted, counts = [], D.ReportDeltas.counts
    monkeypatch.setattr(D.ReportDeltas, "counts", lambda run, *a: counted.append(plan(counts(run, *a))) or counts(run, *a))
    monkeypatch.setattr(D, "fits_broadcast", lambda *a: False)
    store = TableStore(spark, scratch_path(spark, "looked-up"), buckets=3, part_width=100)
    for stamp, batch in moved_feed(spark, sf_small)[:2]:
        P.load_raw(store, batch)
        star = P.run_models(spark, store, stamp, with_reports=True)
    assert len(looked) == 4 and len(counted) == 15
    assert all("changed_reports" not in text for text in counted)
    # The reports go into the table's buckets.
    assert all("RepartitionByExpression [dr_no" in text and ", 3" in text for text in looked)
    for name in P.REPORTS:
        assert content(star.table(name)) == content(star.report(name))
