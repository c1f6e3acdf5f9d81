"""End-to-end run: land -> raw merge -> staging -> dimensions -> snapshot ->
bridges -> fact -> reports. Plain function calls in dependency order; every
model is written as a versioned table before its consumers read it.

Incremental models keep their own watermark beside the table (the number of the
last load they have processed) and read only rows of later loads, bounded above
by the raw table's last load at the start of the run.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.checks.rules import summarise_checks
from blotter.checks.suite import (freshness_gate, mart_checks, monitors, raise_on_failures,
                                  source_checks)
from blotter.operators.merge import (assert_unique_keys, broadcast_merge, merge_upsert,
                                     sync_columns)
from blotter.plans import reports as R
from blotter.plans.deltas import ReportDeltas
from blotter.plans.bridges import bridge_crime_code, bridge_mocode
from blotter.operators.joins import fits_broadcast, written
from blotter.plans.dims import (CODE_DIMS, DATE_END, DATE_START, LOCATION_CHECK_COLS, code_dim,
                                code_labels, from_labels, dim_date, dim_mocode, dim_time, dim_victim,
                                location_incoming, newer_only)
from blotter.plans.fact import FACT_COLUMNS, fct_incidents
from blotter.plans.staging import FIRST_LOAD, LOAD_SEQ, stg_incidents
from blotter.session import CO_PARTITION
from blotter.sources.seeds import load_seed
from blotter.sources.snapshots import advance_snapshot
from blotter.sources.store import PART, TableStore

RAW, CORE, REPORTING, INCREMENTS = "raw", "mart_core", "mart_reporting", "increments"
CHECKS = "mart_checks"
RAW_TABLE = "raw_incidents"
RAW_KEY = ["dr_no"]
MERGE_ACTIONS = ["insert", "update", "unchanged", "keep"]
# Fact and bridges are bucketed on the report number with one bucket count, so
# fact x bridge joins read co-partitioned inputs.
CO_KEY = ["dr_no"]

CORE_TABLES = ["dim_date", "dim_time", "dim_mocode", "dim_area", "dim_status", "dim_premise",
               "dim_weapon", "dim_crime_code", "dim_victim", "dim_location",
               "bridge_crime_code", "bridge_mocode", "fct_incidents"]
# Fact and bridges: merge keys and the columns a merge updates.
LIVE_MODELS = {"bridge_crime_code": (["dr_no", "crime_code_dim_id"], ["dlu"]),
               "bridge_mocode": (["dr_no", "mocode_dim_id"], ["dlu"]),
               "fct_incidents": (["dr_no"], [c for c in FACT_COLUMNS if c not in ("dr_no", "doe")])}
REPORTS = ["area_monthly_summary", "crime_code_seasonality", "location_density",
           "victim_demographics", "weapon_distribution"]


@dataclass
class Star:
    """Handle on a built mart: tables read back from the store, with the row
    counts their writes measured."""
    store: TableStore
    load_ts: str
    rows: dict[str, int] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        schema = REPORTING if name in REPORTS else RAW if name == RAW_TABLE else CORE
        df = self.store.read(schema, name)
        if df is None:
            raise KeyError(f"table {schema}.{name} has not been built")
        return df.drop(FIRST_LOAD)

    def stg(self) -> DataFrame:
        return stg_incidents(self.table(RAW_TABLE))

    def report(self, name: str) -> DataFrame:
        t = self.table
        if name == "area_monthly_summary":
            return R.area_monthly_summary(t("fct_incidents"), t("dim_date"), t("dim_area"),
                                          self.load_ts, self.rows)
        if name == "crime_code_seasonality":
            return R.crime_code_seasonality(t("fct_incidents"), t("bridge_crime_code"),
                                            t("dim_crime_code"), t("dim_date"), self.rows)
        if name == "location_density":
            return R.location_density(t("fct_incidents"), t("bridge_crime_code"),
                                      t("dim_crime_code"), t("dim_date"), t("dim_time"),
                                      t("dim_location"), self.rows)
        if name == "victim_demographics":
            return R.victim_demographics(t("fct_incidents"), t("dim_victim"), self.rows)
        if name == "weapon_distribution":
            return R.weapon_distribution(t("fct_incidents"), t("dim_time"), t("dim_area"),
                                         t("dim_weapon"), self.rows)
        raise KeyError(name)


def load_raw(store: TableStore, batch: DataFrame, change_cols: list[str] | None = None) -> DataFrame:
    """Land one batch (truncate-and-load into the landing table), then MERGE it
    into the raw table on ``dr_no``. A row counts as changed when any column
    but the key and the load stamp differs, so a re-sent unchanged row keeps
    its old stamp and is not processed again downstream.

    Loads are numbered: rows that a load inserts or changes carry its number
    (``load_seq``), and every model reads the loads it has not seen. Load
    stamps may therefore repeat or go back without a row being missed.

    Only the partitions that the batch falls into are read and replaced. The
    first load has nothing to merge with: it sizes the table (see
    ``TableStore.fit_layout``) and its keys are checked on the written table
    before that becomes visible."""
    number = (store.watermark(RAW, RAW_TABLE) or 0) + 1
    batch = batch.withColumn(LOAD_SEQ, F.lit(number).cast("long"))
    if store.meta(RAW, RAW_TABLE) is None:
        return store.write_live(batch, RAW, RAW_TABLE, RAW_KEY, number, layout=store.fit_layout(batch, RAW_KEY[0]),
                                validate=lambda written: assert_unique_keys(written, RAW_KEY, "batch"))
    landed = store.write(batch, INCREMENTS, "landing")
    n = store.rows(INCREMENTS, "landing")
    if n == 0:
        return store.read(RAW, RAW_TABLE)
    if change_cols is None:
        change_cols = [c for c in batch.columns if c not in RAW_KEY + ["dl_upd", LOAD_SEQ]]
    parts = store.touched(landed, RAW, RAW_TABLE)
    current = _rows_in(store, RAW, RAW_TABLE, parts)
    merged = merge_upsert(sync_columns(current, landed), landed, RAW_KEY, change_cols=change_cols,
                          source_rows=n, insert_partitioning=(store.live_buckets(RAW, RAW_TABLE), RAW_KEY),
                          with_action=True)
    # Bucketed on the merge key, so neither merge plan ever shuffles the raw
    # table (the broadcast plan streams it, the full outer plan shuffles only
    # the batch into the bucket layout). Rows affected by the MERGE are counted
    # in the same pass as the write.
    actions = {a: F.sum((F.col("_action") == a).cast("long")) for a in MERGE_ACTIONS}
    return store.write_live(merged, RAW, RAW_TABLE, RAW_KEY, number, prepartitioned=True,
                            metrics=actions, drop=("_action",), parts=parts)


def _rows_in(store: TableStore, schema: str, name: str, parts: list[int]) -> DataFrame:
    """Rows of a live table in some partitions: a partition filter, so no other
    file is read."""
    return store.read_live(schema, name).filter(F.col(PART).isin(parts)).drop(PART)


def _touched_rows(store: TableStore, schema: str, name: str, increment: DataFrame) -> DataFrame:
    """Rows of a live table in the partitions that ``increment`` falls into."""
    return _rows_in(store, schema, name, store.touched(increment, schema, name))


def loads_after(store: TableStore, watermark: int, upto: int) -> DataFrame:
    """Staged rows of the loads after ``watermark`` up to ``upto``: typed once
    and written, from the partitions that those loads have touched."""
    parts = store.parts_since(RAW, RAW_TABLE, watermark)
    raw = store.read(RAW, RAW_TABLE) if parts is None else _rows_in(store, RAW, RAW_TABLE, parts)
    fresh = raw.filter((F.col(LOAD_SEQ) > watermark) & (F.col(LOAD_SEQ) <= upto))
    return written(stg_incidents(fresh), "loads")


def late_keys(store: TableStore, name: str, watermark) -> DataFrame | None:
    """Codes that the merges of dimension ``name`` have inserted since load
    ``watermark``: the change set that its merges leave in the dimension itself
    (the load of each row's insert), so it outlives a run that failed between a
    dimension and its consumers. The last insert is known from the write: where
    there is none, no job runs and the result is ``None``."""
    last = ((store.meta(CORE, name) or {}).get("metrics") or {}).get(FIRST_LOAD)
    if watermark is None or last is None or int(last) <= watermark:
        return None
    return store.read(CORE, name).filter((F.col(FIRST_LOAD) > watermark) & F.col("code").isNotNull()).select("code")


def merge_counts(store: TableStore) -> dict:
    """Rows inserted / updated / unchanged / kept by the last raw MERGE."""
    m = store.meta(RAW, RAW_TABLE) or {}
    return {k: int(v or 0) for k, v in (m.get("metrics") or {}).items()}


def _merge_model(store: TableStore, name: str, increment: DataFrame, keys: list[str],
                 update_cols: list[str] | None, watermark, inserted: bool = False) -> DataFrame:
    """A dimension. First run: write the increment. Later runs: stage it (its
    row count picks the merge plan), merge, write the next version. With
    ``inserted`` each row keeps the load that inserted it (see ``late_keys``)."""
    metrics = None
    if inserted:
        increment = increment.withColumn(FIRST_LOAD, F.lit(watermark).cast("long"))
        metrics = {FIRST_LOAD: F.max(FIRST_LOAD)}
    current = store.read(CORE, name)
    if current is None:
        return store.write(increment, CORE, name, watermark=watermark, metrics=metrics)
    inc = store.write(increment, INCREMENTS, name)
    merged = merge_upsert(sync_columns(current, inc), inc, keys, update_cols=update_cols,
                          check_unique=False, source_rows=store.rows(INCREMENTS, name))
    return store.write(merged, CORE, name, watermark=watermark, metrics=metrics)


def _merge_live(store: TableStore, name: str, inc: DataFrame, keys: list[str],
                update_cols: list[str], watermark, dealt: bool = False) -> DataFrame:
    """Fact and bridges: as above, but only the partitions that the staged
    increment falls into are read and replaced, and the bucket layout is kept
    without a reshuffle. ``dealt``: the rows of a first build are in their
    buckets already."""
    if store.meta(CORE, name) is None:
        # In the raw table's layout: partitions of one are partitions of all.
        return store.write_live(inc, CORE, name, CO_KEY, watermark, prepartitioned=dealt,
                                layout=store.layout(RAW, RAW_TABLE))
    n = store.rows(INCREMENTS, name)
    parts = store.touched(inc, CORE, name)
    current = _rows_in(store, CORE, name, parts)
    merged = merge_upsert(sync_columns(current, inc), inc, keys, update_cols=update_cols,
                          check_unique=False, source_rows=n,
                          insert_partitioning=(store.live_buckets(CORE, name), CO_KEY))
    # Each task holds whole buckets when the merge streamed the bucketed
    # target (broadcast plan) or joined it bucket by bucket, as it does on more
    # keys than the bucket's where the session lets it (see ``session``).
    aligned = (broadcast_merge(n, inc.schema) or list(keys) == CO_KEY
               or set(CO_KEY) <= set(keys) and store.spark.conf.get(CO_PARTITION) == "false")
    return store.write_live(merged, CORE, name, CO_KEY, watermark, prepartitioned=aligned, parts=parts)


def _run_wave(jobs: dict, done, parallel: int) -> None:
    """Run independent model builds; Spark schedules their jobs side by side
    (one driver thread per model, as a model runner's threads would)."""
    if parallel <= 1:
        for name, fn in jobs.items():
            done(name, fn())
        return
    with ThreadPoolExecutor(max_workers=min(parallel, len(jobs))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        for name, fut in futures.items():
            done(name, fut.result())


def run_models(spark: SparkSession, store: TableStore, load_ts: str,
               date_range: tuple[str, str] = (DATE_START, DATE_END),
               with_reports: bool = False, parallel: int = 8) -> Star:
    """Build or advance every core model from the raw table."""
    raw = store.read(RAW, RAW_TABLE)
    if raw is None:
        raise RuntimeError("raw table is empty: load a batch first")
    upto = store.watermark(RAW, RAW_TABLE)
    stg = stg_incidents(raw)
    descent = load_seed(spark, "descent_mapping")
    mocodes = load_seed(spark, "mocodes")
    star = Star(store, load_ts)
    dims: dict[str, DataFrame] = {}

    def done(name: str, df: DataFrame) -> DataFrame:
        dims[name] = df
        star.rows[name] = store.rows(CORE, name)
        return df

    # Rows of new loads are staged once per watermark that a model stands at
    # (one, unless an earlier run failed in between).
    incremental = [n for n, spec in CODE_DIMS.items() if spec.incremental] + [
        "dim_victim", "dim_location", *LIVE_MODELS]
    marks = {n: store.watermark(CORE, n) for n in incremental}
    windows = {w: loads_after(store, w, upto) for w in set(marks.values()) if w is not None}

    def fresh(name: str) -> DataFrame:
        return windows.get(marks[name], stg)

    # The code dimensions share one scan of the loads they have not seen (those
    # that are rebuilt in every run only share it on the first).
    known = [marks[n] for n, spec in CODE_DIMS.items() if spec.incremental]
    seen = None if None in known else min(known)
    shared = [s for s in CODE_DIMS.values() if s.incremental or not seen]
    labels = store.write(code_labels(windows.get(seen, stg), shared), INCREMENTS, "code_labels")

    def code_model(name: str) -> DataFrame:
        spec = CODE_DIMS[name]
        if not spec.incremental:
            full = code_dim(stg, spec, load_ts) if seen else from_labels(labels, stg, spec, load_ts)
            return store.write(full, CORE, name)
        inc = from_labels(labels, stg, spec, load_ts)
        current = store.read(CORE, name)
        if current is not None:
            inc = newer_only(inc, current, ["source_dlu", spec.label_as])
        return _merge_model(store, name, inc, [spec.unique_key], list(spec.update_cols), upto, inserted=True)

    def victim_model() -> DataFrame:
        inc = dim_victim(fresh("dim_victim"), descent, load_ts)
        current = store.read(CORE, "dim_victim")
        if current is not None:
            inc = newer_only(inc, current, ["source_dlu"])
        return _merge_model(store, "dim_victim", inc, ["id"],
                            ["age", "sex", "descent", "source_dlu", "dlu"], upto)

    def location_model() -> DataFrame:
        return advance_snapshot(store, CORE, "dim_location", location_incoming(fresh("dim_location"), load_ts),
                                ["id"], LOCATION_CHECK_COLS, load_ts, upto, key_covers_checks=True)

    # Wave 1: every dimension (independent of each other). Generated and seed
    # tables are full refreshes, code dimensions merge the loads they have not
    # seen, and places staged since the location snapshot's
    # watermark are compared with its open versions.
    wave1 = {
        "dim_date": lambda: store.write(dim_date(spark, load_ts, *date_range), CORE, "dim_date"),
        "dim_time": lambda: store.write(dim_time(spark, load_ts), CORE, "dim_time"),
        "dim_mocode": lambda: store.write(dim_mocode(mocodes, load_ts), CORE, "dim_mocode"),
        "dim_victim": victim_model,
        "dim_location": location_model,
    }
    for name in ("dim_area", "dim_status", "dim_premise", "dim_weapon", "dim_crime_code"):
        wave1[name] = (lambda n: (lambda: code_model(n)))(name)
    _run_wave(wave1, done, parallel)

    # Wave 2: bridges and fact over rows with wm < load_seq <= upto and the
    # older rows that new codes and premises bring back; the merge keeps an
    # existing doe (first seen) and refreshes dlu. A first build deals out the
    # rows before they get the dimensions' keys (nine texts of 32 characters a
    # fact), which then pass no exchange; that holds while every lookup is a
    # broadcast.
    layout = store.layout(RAW, RAW_TABLE)
    dealt = layout is not None and all(
        fits_broadcast(star.rows[n], dims[n].schema) for n in dims if n != "dim_location")
    first = stg.filter(F.col(LOAD_SEQ) <= upto).repartition(layout[0], *CO_KEY) if dealt else None

    increments = {
        "bridge_crime_code": lambda: bridge_crime_code(
            stg, dims["dim_crime_code"], load_ts, marks["bridge_crime_code"], star.rows["dim_crime_code"], upto,
            late=late_keys(store, "dim_crime_code", marks["bridge_crime_code"]),
            fresh=windows.get(marks["bridge_crime_code"], first)),
        "bridge_mocode": lambda: bridge_mocode(
            stg, dims["dim_mocode"], load_ts, marks["bridge_mocode"], star.rows["dim_mocode"], upto,
            fresh=windows.get(marks["bridge_mocode"], first)),
        "fct_incidents": lambda: fct_incidents(
            stg, dims, descent, load_ts, star.rows, marks["fct_incidents"], upto,
            late=late_keys(store, "dim_premise", marks["fct_incidents"]),
            fresh=windows.get(marks["fct_incidents"], first)),
    }
    staged_inc: dict[str, DataFrame] = {}

    def stage_increment(name: str) -> DataFrame:
        inc = increments[name]()
        return inc if marks[name] is None else store.write(inc, INCREMENTS, name)

    def merge_live(name: str) -> DataFrame:
        keys, updated = LIVE_MODELS[name]
        return _merge_live(store, name, staged_inc[name], keys, updated, upto, dealt)

    def advance_live(name: str) -> DataFrame:
        staged_inc[name] = stage_increment(name)
        return merge_live(name)

    if not with_reports:
        _run_wave({n: (lambda n=n: advance_live(n)) for n in LIVE_MODELS}, done, parallel)
    else:
        # The reports' old rows are counted between the increments and the merges.
        _run_wave({n: (lambda n=n: stage_increment(n)) for n in LIVE_MODELS}, staged_inc.__setitem__, parallel)
        deltas = ReportDeltas(store, star, marks, staged_inc, date_range)
        deltas.before_merge(parallel)
        _run_wave({n: (lambda n=n: merge_live(n)) for n in LIVE_MODELS}, done, parallel)
        # Wave 3: the reports, from the counts that the load has changed.
        deltas.after_merge(upto, parallel)

        def report_done(name: str, _df: DataFrame) -> None:
            star.rows[name] = store.rows(REPORTING, name)

        _run_wave({name: (lambda n: (lambda: store.write(deltas.report(n), REPORTING, n)))(name)
                   for name in REPORTS}, report_done, parallel)
    return star


def run_pipeline(spark: SparkSession, store: TableStore, batch: DataFrame, load_ts: str,
                 with_reports: bool = True, with_checks: bool = True) -> Star:
    """One scheduled run: load a batch, check the source (freshness at
    ``load_ts``, required columns, unique report numbers), advance every model,
    write the reports, then run the mart's declared checks and monitors. A
    stale source or a failed check fails the run. Check rows, their summary and
    the monitors' findings are written to ``mart_checks``."""
    load_raw(store, batch)
    if with_checks:
        raw = store.read(RAW, RAW_TABLE)
        store.write(freshness_gate(raw, load_ts), CHECKS, "source_freshness")
        raise_on_failures(store.write(source_checks(raw), CHECKS, "source_checks"))
    star = run_models(spark, store, load_ts, with_reports=with_reports)
    if with_checks:
        results = store.write(mart_checks(star), CHECKS, "check_results")
        store.write(summarise_checks(results), CHECKS, "check_summary")
        report = star.table("area_monthly_summary") if with_reports else None
        store.write(monitors(star, report), CHECKS, "monitor_results")
        raise_on_failures(results)
    return star


def row_counts(star: Star, names: list[str]) -> DataFrame:
    """(table_name, row_count) per table, each counted by Spark from the table."""
    parts = [star.table(n).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
