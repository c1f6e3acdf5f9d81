import os
import tempfile

from pyspark.sql import functions as F

from blotter.plans import pipeline as P
from blotter.plans.queries import RUN_TS, batch_star, change_feed, full_star
from blotter.session import scratch_path
from blotter.sources.fixture import BATCH_STAMPS, incident_fixture
from blotter.sources.landing import read_incidents_csv, with_load_ts
from blotter.sources.store import TableStore
from blotter.streaming.ingest import ingest_available

STAMPS = {"doe", "dlu", "source_dlu", "valid_from", "valid_to"}


def content(df):
    cols = sorted(c for c in df.columns if c not in STAMPS)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


def test_replay_equals_one_shot_build(spark, sf_small):
    """Three incremental runs give the same mart as one build over the final raw rows."""
    inc = batch_star(spark, sf_small)
    final_raw = inc.table(P.RAW_TABLE)
    store = TableStore(spark, scratch_path(spark, "replay"))
    P.load_raw(store, final_raw.drop("load_seq"))
    once = P.run_models(spark, store, RUN_TS)
    for name in P.CORE_TABLES:
        assert content(inc.table(name)) == content(once.table(name)), name


def test_first_seen_and_last_update(spark, sf_small):
    fact = batch_star(spark, sf_small).table("fct_incidents")
    raw = batch_star(spark, sf_small).table(P.RAW_TABLE)
    j = fact.join(raw.select(F.col("dr_no").cast("long").alias("dr_no"), "dl_upd", "status", "premis_cd"), "dr_no")
    # Premise 149 gets its text in the last batch: its older rows are processed again then.
    late = F.coalesce(F.col("premis_cd") == "149", F.lit(False))
    assert j.filter(~late & (F.col("dlu") != F.col("dl_upd"))).count() == 0
    assert j.filter(late & ((F.col("dlu") != BATCH_STAMPS[2]) | F.col("premis_dim_id").isNull())).count() == 0
    assert j.filter(late & (F.col("dl_upd") < BATCH_STAMPS[2])).count() > 0
    changed = j.filter(F.col("status") == "AR")
    assert changed.filter(F.col("doe") >= F.col("dlu")).count() == 0
    assert changed.count() > 0


def test_rerun_without_new_data_changes_nothing(spark, sf_small):
    store = TableStore(spark, scratch_path(spark, "rerun"))
    (s1, b1), _, _ = change_feed(spark, sf_small)
    P.load_raw(store, b1)
    first = P.run_models(spark, store, s1)
    before = {n: sorted(map(tuple, first.table(n).collect())) for n in ("fct_incidents", "bridge_mocode")}
    P.load_raw(store, b1)
    again = P.run_models(spark, store, "2024-01-11 00:00:00")
    for n, rows in before.items():
        assert sorted(map(tuple, again.table(n).collect())) == rows, n


def test_fact_build_is_one_stage(spark, sf_small):
    star = full_star(spark, sf_small)
    from blotter.plans.fact import fct_incidents
    from blotter.sources.seeds import load_seed
    dims = {n: star.table(n) for n in P.CORE_TABLES if n.startswith("dim_")}
    f = fct_incidents(star.stg(), dims, load_seed(spark, "descent_mapping"), RUN_TS, star.rows)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_first_build_deals_out_rows_before_they_get_keys(spark, sf_small, monkeypatch):
    """Fact and bridges: one exchange into the buckets, below every lookup."""
    plans = {}
    write = TableStore.write_live

    def watched(self, df, schema, name, *a, **k):
        if name in P.LIVE_MODELS:
            plans[name] = df._jdf.queryExecution().executedPlan().toString().split("\n"), k["prepartitioned"]
        return write(self, df, schema, name, *a, **k)

    monkeypatch.setattr(TableStore, "write_live", watched)
    store = TableStore(spark, scratch_path(spark, "dealt"))
    P.load_raw(store, incident_fixture(spark, sf_small))
    P.run_models(spark, store, RUN_TS)
    assert set(plans) == set(P.LIVE_MODELS)
    for name, (lines, prepartitioned) in plans.items():
        deal = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
        # The streamed side of the joins comes first in the plan.
        joins = [i for i, x in enumerate(lines) if "BroadcastHashJoin" in x]
        assert prepartitioned and len(deal) == 1 and joins and joins[0] < deal[0], name
        assert not any("md5" in x for x in lines[deal[0]:]), name


def test_landing_csv_quotes_and_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="landing-")
    header = ",".join(["dr_no", "date_rptd", "date_occ", "time_occ", "area", "area_name", "rpt_dist_no",
                       "part_1_2", "crm_cd", "crm_cd_desc", "mocodes", "vict_age", "vict_sex", "vict_descent",
                       "premis_cd", "premis_desc", "weapon_used_cd", "weapon_desc", "status", "status_desc",
                       "crm_cd_1", "crm_cd_2", "crm_cd_3", "crm_cd_4", "location", "cross_street", "lat", "lon"])
    line = ('1,01/02/2024 12:00:00 AM,01/01/2024 12:00:00 AM,5,1,Central,101,1,110,"THEFT, PETTY",'
            '0416 0417,30,M,H,101,"SAY ""HI""",,NULL,IC,Invest Cont,110,,,,100 MAIN,,34.05,-118.25')
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write(header + "\n" + line + "\n")
    r = read_incidents_csv(spark, d).first()
    assert r.crm_cd_desc == "THEFT, PETTY" and r.premis_desc == 'SAY "HI"'
    assert r.weapon_used_cd is None and r.weapon_desc is None and r.cross_street is None
    assert with_load_ts(read_incidents_csv(spark, d), RUN_TS).first().dl_upd is not None


def test_streaming_ingest_drains_new_files_once(spark, sf_small):
    from blotter.sources.landing import write_landing_csv
    from blotter.sources.fixture import incident_fixture
    land = tempfile.mkdtemp(prefix="landing-stream-")
    fx = incident_fixture(spark, sf_small).drop("dl_upd")
    write_landing_csv(fx.filter("CAST(dr_no AS BIGINT) % 2 = 0"), os.path.join(land, "part1"))
    store = TableStore(spark, scratch_path(spark, "stream-store"))
    ckpt = scratch_path(spark, "stream-ckpt")
    clock = iter(["2024-03-01 00:00:00", "2024-03-02 00:00:00", "2024-03-03 00:00:00"])
    import datetime as dt
    tick = lambda: dt.datetime.fromisoformat(next(clock))
    stamps = ingest_available(spark, os.path.join(land, "*"), store, ckpt, tick, advance_models=False)
    assert len(stamps) == 1
    assert store.read(P.RAW, P.RAW_TABLE).count() == fx.filter("CAST(dr_no AS BIGINT) % 2 = 0").count()
    assert ingest_available(spark, os.path.join(land, "*"), store, ckpt, tick, advance_models=False) == []


def test_fact_bridge_join_reads_co_partitioned(spark, sf_small):
    """Fact and bridge are bucketed on dr_no: their join has no exchange."""
    star = full_star(spark, sf_small)
    df = star.report("crime_code_seasonality")
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert "hashpartitioning(dr_no" not in plan


def test_bucketed_merge_keeps_layout(spark, sf_small):
    """Incremental merges rewrite each bucket in its own task: file counts
    stay bounded by two per bucket instead of growing with tasks x buckets."""
    import glob
    star = batch_star(spark, sf_small)
    store = star.store
    for schema, t in ((P.CORE, "fct_incidents"), (P.CORE, "bridge_crime_code"),
                      (P.CORE, "bridge_mocode"), (P.RAW, P.RAW_TABLE)):
        path = store._live_path(schema, t).replace("file:", "")
        for part in glob.glob(path + "/dr_part=*"):
            assert len(glob.glob(part + "/*.parquet")) <= 2 * store.buckets, t


def test_location_density_plans_agree(spark, sf_small):
    """Both location plans (broadcast-first and reduce-first) give one result."""
    from blotter.plans import reports as R
    star = full_star(spark, sf_small)
    t = star.table
    args = (t("fct_incidents"), t("bridge_crime_code"), t("dim_crime_code"), t("dim_date"),
            t("dim_time"), t("dim_location"))
    small = R.location_density(*args, star.rows)
    large = R.location_density(*args, dict(star.rows, dim_location=10 ** 12))
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)


def test_missing_landing_path_fails(spark):
    import pytest
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_incidents_csv(spark, "/nonexistent/landing/folder").count()


def test_run_pipeline_writes_reports(spark, sf_small):
    store = TableStore(spark, scratch_path(spark, "run-pipeline"))
    (s1, b1), _, _ = change_feed(spark, sf_small)
    star = P.run_pipeline(spark, store, b1, s1)
    for name in P.REPORTS:
        written = star.table(name)
        assert written.count() == star.rows[name] > 0, name
    assert content(star.table("crime_code_seasonality")) == content(star.report("crime_code_seasonality"))


def test_raw_merge_reports_rows_affected(spark, sf_small):
    store = TableStore(spark, scratch_path(spark, "merge-counts"))
    feed = change_feed(spark, sf_small)
    (s1, b1), (s2, b2), (s3, b3) = feed
    n1 = b1.count()
    P.load_raw(store, b1)
    P.load_raw(store, b2)
    resent = b1.filter("CAST(dr_no AS BIGINT) % 10 = 0").count()
    c2 = P.merge_counts(store)
    assert c2 == {"insert": b2.count() - resent, "update": resent, "unchanged": 0, "keep": n1 - resent}
    P.load_raw(store, b3)
    c3 = P.merge_counts(store)
    unchanged = b1.filter("CAST(dr_no AS BIGINT) % 10 = 1").count()
    assert c3["unchanged"] == unchanged and c3["update"] == 0
    assert c3["insert"] == b3.count() - unchanged
    assert "_action" not in store.read(P.RAW, P.RAW_TABLE).columns


def test_streaming_ingest_advances_models(spark, sf_small):
    import datetime as dt
    from blotter.sources.fixture import incident_fixture
    from blotter.sources.landing import write_landing_csv
    land = tempfile.mkdtemp(prefix="landing-models-")
    fx = incident_fixture(spark, sf_small).drop("dl_upd")
    evens, odds = fx.filter("CAST(dr_no AS BIGINT) % 2 = 0"), fx.filter("CAST(dr_no AS BIGINT) % 2 = 1")
    write_landing_csv(evens, os.path.join(land, "a"))
    store = TableStore(spark, scratch_path(spark, "stream-models"))
    ckpt = scratch_path(spark, "stream-models-ckpt")
    ticks = iter([dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)])
    ingest_available(spark, os.path.join(land, "*"), store, ckpt, lambda: next(ticks))
    assert store.read(P.CORE, "fct_incidents").count() == evens.count()
    write_landing_csv(odds, os.path.join(land, "b"))
    ingest_available(spark, os.path.join(land, "*"), store, ckpt, lambda: next(ticks))
    fact = store.read(P.CORE, "fct_incidents")
    assert fact.count() == fx.count()
    assert P.merge_counts(store)["insert"] == odds.count()
    assert fact.filter("doe = TIMESTAMP_NTZ'2024-03-01 00:00:00'").count() == evens.count()


def test_mart_checks_pass_and_catch_a_broken_key(spark, sf_small):
    import pytest
    from blotter.checks.suite import DataCheckError, mart_checks, raise_on_failures
    star = full_star(spark, sf_small)
    results = mart_checks(star)
    assert results.filter("NOT passed").count() == 0
    assert results.count() > 40
    broken = results.unionByName(spark.createDataFrame(
        [("unique", "fct_incidents", "dr_no", 2, False)], results.schema))
    with pytest.raises(DataCheckError, match="fct_incidents.dr_no"):
        raise_on_failures(broken)


def test_equal_and_older_stamps_are_processed(spark, sf_small):
    from blotter.operators.incremental import ts_literal
    from blotter.sources.fixture import incident_fixture
    store = TableStore(spark, scratch_path(spark, "same-stamp"))
    fx, third = incident_fixture(spark, sf_small), F.col("dr_no").cast("long") % 3
    for part, stamp in ((0, BATCH_STAMPS[1]), (1, BATCH_STAMPS[1]), (2, BATCH_STAMPS[0])):
        P.load_raw(store, fx.filter(third == part).withColumn("dl_upd", ts_literal(stamp)))
        star = P.run_models(spark, store, RUN_TS)
    assert star.table("fct_incidents").count() == fx.count()
    final = star.table(P.RAW_TABLE).drop("load_seq")
    once = TableStore(spark, scratch_path(spark, "same-stamp-once"))
    P.load_raw(once, final)
    whole = P.run_models(spark, once, RUN_TS)
    for name in P.CORE_TABLES:
        assert content(star.table(name)) == content(whole.table(name)), name


def test_small_load_leaves_other_partitions_alone(spark, sf_small):
    import glob
    from blotter.sources.fixture import incident_fixture
    store = TableStore(spark, scratch_path(spark, "small-load"), buckets=2, part_width=100)
    fx = incident_fixture(spark, sf_small)
    n = F.col("dr_no").cast("long")
    P.load_raw(store, fx)
    P.run_models(spark, store, RUN_TS)
    live = [(P.RAW, P.RAW_TABLE), (P.CORE, "fct_incidents"), (P.CORE, "bridge_crime_code"), (P.CORE, "bridge_mocode")]

    def files():
        return {p: os.path.getmtime(p) for s, t in live
                for p in glob.glob(store._live_path(s, t).replace("file:", "") + "/dr_part=*/*.parquet")}

    before = files()
    P.load_raw(store, fx.filter(n.between(200, 299)).withColumn("status", F.lit("AR")))
    star = P.run_models(spark, store, "2024-02-02 00:00:00")
    after = files()
    untouched = {p for p in before if "/dr_part=2/" not in p}
    assert len(untouched) > 20 and all(after.get(p) == before[p] for p in untouched)
    assert {p for p in after if "/dr_part=2/" in p}.isdisjoint(before)
    assert star.table("fct_incidents").count() == fx.count()
    changed = star.table(P.RAW_TABLE).filter("status = 'AR'")
    assert changed.count() == fx.filter(n.between(200, 299)).count()


def test_merge_reads_touched_partitions_only(spark, sf_small):
    from blotter.sources.fixture import incident_fixture
    store = TableStore(spark, scratch_path(spark, "pruned"), buckets=2, part_width=100)
    fx = incident_fixture(spark, sf_small)
    P.load_raw(store, fx)
    some = fx.filter(F.col("dr_no").cast("long").between(200, 299)).withColumn("load_seq", F.lit(2).cast("long"))
    plan = P._touched_rows(store, P.RAW, P.RAW_TABLE, some)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [dr_part" in plan and "In" in plan or "dr_part#" in plan.split("PartitionFilters")[1][:80]


def test_no_single_task_limit_in_merge_and_snapshot_plans(spark, sf_small):
    from blotter.plans.queries import queries
    for name in ("merge_update_columns_subset", "merge_schema_sync", "first_seen_carry", "snapshot_status_history"):
        plan = queries()[name](spark, sf_small)._jdf.queryExecution().toString()
        assert "GlobalLimit" not in plan, name


def test_dimensions_use_hash_aggregates(spark, sf_small):
    from blotter.plans import dims as D
    from blotter.plans.queries import queries
    from blotter.plans.staging import stg_incidents
    from blotter.sources.fixture import incident_fixture
    from blotter.sources.seeds import load_seed
    stg = stg_incidents(incident_fixture(spark, sf_small))
    frames = [D.code_dim(stg, spec, RUN_TS) for spec in D.CODE_DIMS.values()]
    frames += [D.dim_victim(stg, load_seed(spark, "descent_mapping"), RUN_TS), D.location_incoming(stg, RUN_TS),
               queries()["customer_latest_order"](spark, sf_small)]
    for df in frames:
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_unique_check_of_the_fact_has_no_exchange_by_key(spark, sf_small):
    from blotter.checks.rules import check_unique
    plan = check_unique(full_star(spark, sf_small).table("fct_incidents"), "fct_incidents", ["dr_no"])
    assert "hashpartitioning(__v" not in plan._jdf.queryExecution().executedPlan().toString()


def test_run_writes_source_checks_summary_and_monitors(spark, sf_small):
    import pytest
    from blotter.checks.suite import DataCheckError
    store = TableStore(spark, scratch_path(spark, "run-checks"))
    feed = change_feed(spark, sf_small)
    P.run_pipeline(spark, store, feed[0][1], feed[0][0])
    assert store.read(P.CHECKS, "source_checks").filter("NOT passed").count() == 0
    assert store.read(P.CHECKS, "source_freshness").first().status == "pass"
    summary = {r.table: r for r in store.read(P.CHECKS, "check_summary").collect()}
    assert summary["fct_incidents"].failed_checks == 0 and summary["fct_incidents"].checks > 10
    assert {r.monitor for r in store.read(P.CHECKS, "monitor_results").select("monitor").distinct().collect()} <= {
        "freshness", "column", "volume", "schema_change"}
    with pytest.raises(DataCheckError, match="stale"):  # nothing new for a month
        P.run_pipeline(spark, store, feed[0][1].limit(0), "2024-03-01 00:00:00")
    missing = feed[0][1].withColumn("area", F.lit(None).cast("string"))
    with pytest.raises(DataCheckError, match="area"):
        P.run_pipeline(spark, TableStore(spark, scratch_path(spark, "run-missing")), missing, feed[0][0])


def test_reordered_landing_header_fails(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="landing-order-")
    from blotter.schemas import RAW_TEXT_COLUMNS
    names = list(RAW_TEXT_COLUMNS)
    names[0], names[1] = names[1], names[0]
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write(",".join(names) + "\n" + ",".join(["1"] * len(names)) + "\n")
    with pytest.raises(Exception):
        read_incidents_csv(spark, d).collect()
