"""Report counts kept from load to load.

A full refresh of a report counts every fact. A load changes few of them: for
the reports whose increment the load brings (fact or bridge), the rows of these
reports are counted as they were before the merge and as they are after it, and
the difference is added to the stored counts. Old rows thus leave with -1 and
new ones come with +1; a report that moves from one area to another changes two
groups. Only the partitions of the touched reports are read. Labels, totals and
shares are made of the stored counts (see ``plans/reports``).

Counts stored by a run carry the load they stand at. They are used by the next
run only if they stand exactly where fact and bridge stood before it (a run that
failed in between leaves them behind) and were made with the same calendar;
otherwise they are counted anew.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.counts import add_counts, signed
from blotter.operators.joins import bounded_broadcast, fits_broadcast, staged, written
from blotter.plans import reports as R
from blotter.sources.store import PART

STATE, CORE = "mart_state", "mart_core"
FACT, BRIDGE = "fct_incidents", "bridge_crime_code"
KEYS = {"area_counts": R.AREA_KEYS, "month_counts": R.MONTH_KEYS, "cell_counts": R.CELL_KEYS,
        "victim_counts": R.VICTIM_KEYS, "weapon_counts": R.WEAPON_KEYS}
# The columns that any of the counts is made of.
COUNTED = {FACT: ["dr_no", "date_occ_id", "time_occ_id", "area_dim_id", "victims_id", "weapons_id", "location_dim_id"],
           BRIDGE: ["dr_no", "crime_code_dim_id"]}


class ReportDeltas:
    """The stored counts of one run: ``before_merge`` when the increments are
    staged and the dimensions are advanced, ``after_merge`` when fact and
    bridges are."""

    def __init__(self, store, star, marks: dict, increments: dict[str, DataFrame], date_range: tuple[str, str]):
        self.store, self.star, self.increments = store, star, increments
        self.calendar = "..".join(date_range)
        at = marks[FACT]
        self.advance = at is not None and at == marks[BRIDGE] and all(
            self._stands_at(name) == (at, self.calendar) for name in KEYS)

    def _stands_at(self, name: str):
        meta = self.store.meta(STATE, name) or {}
        return meta.get("watermark"), (meta.get("metrics") or {}).get("calendar")

    def counts(self, name: str, fact: DataFrame, bridge: DataFrame) -> DataFrame:
        t, rows = self.star.table, self.star.rows
        if name == "month_counts":
            return R.month_counts(fact, bridge, t("dim_crime_code"), t("dim_date"), rows)
        if name == "cell_counts":
            return R.cell_counts(fact, bridge, t("dim_crime_code"), t("dim_date"), t("dim_time"),
                                 t("dim_location"), rows)
        return getattr(R, name)(fact)

    def _affected(self, name: str) -> DataFrame:
        """Rows of fact or bridge that belong to the load's reports. Where the
        reports are too many for a broadcast, they alone are dealt out, into the
        table's buckets."""
        rows = self.store.read_live(CORE, name).filter(F.col(PART).isin(self.parts)).select(*COUNTED[name])
        reports = self.reports
        if not fits_broadcast(self.n_reports, reports.schema):
            reports = reports.repartition(self.store.live_buckets(CORE, name), "dr_no")
        return rows.join(bounded_broadcast(reports, self.n_reports), "dr_no", "left_semi")

    def _both(self, parallel: int) -> list[DataFrame]:
        """The affected rows of fact and bridge, looked up once for all reports."""
        def look_up(name: str) -> DataFrame:
            return written(self._affected(name), f"affected_{name}")

        if parallel <= 1:
            return [look_up(FACT), look_up(BRIDGE)]
        with ThreadPoolExecutor(2) as pool:
            return list(pool.map(look_up, [FACT, BRIDGE]))

    def _each(self, work: Callable, parallel: int) -> dict:
        if parallel <= 1:
            return {name: work(name) for name in KEYS}
        with ThreadPoolExecutor(min(parallel, len(KEYS))) as pool:
            return dict(zip(KEYS, pool.map(work, KEYS)))

    def before_merge(self, parallel: int) -> None:
        if not self.advance:
            return
        both = self.increments[FACT].select("dr_no").unionByName(self.increments[BRIDGE].select("dr_no"))
        self.reports, self.n_reports = staged(both.distinct(), "changed_reports")
        self.parts = self.store.touched(self.reports, CORE, FACT)
        fact, bridge = self._both(parallel)
        self.old = self._each(lambda name: staged(self.counts(name, fact, bridge), f"old_{name}")[0], parallel)

    def after_merge(self, upto: int, parallel: int) -> None:
        if self.advance:
            fact, bridge = self._both(parallel)
        else:
            fact, bridge = self.star.table(FACT), self.star.table(BRIDGE)

        def keep(name: str) -> None:
            now = self.counts(name, fact, bridge)
            if self.advance:
                delta, n = staged(signed(self.old[name], now, KEYS[name]), f"delta_{name}")
                now = add_counts(self.store.read(STATE, name), delta, KEYS[name], n)
            self.store.write(now, STATE, name, watermark=upto,
                             metrics={"calendar": F.max(F.lit(self.calendar))})

        self._each(keep, parallel)

    def report(self, name: str) -> DataFrame:
        """A report out of the stored counts."""
        return report_from_counts(self.star, name)


def report_from_counts(star, name: str) -> DataFrame:
    """The report ``name`` made of the mart's stored counts."""
    t, rows = star.table, star.rows
    state = lambda s: star.store.read(STATE, s)
    if name == "area_monthly_summary":
        return R.area_report(state("area_counts"), t("dim_date"), t("dim_area"), star.load_ts, rows)
    if name == "crime_code_seasonality":
        return R.seasonality_report(state("month_counts"), t("dim_crime_code"), rows)
    if name == "location_density":
        return R.density_report(state("cell_counts"), t("dim_crime_code"), rows)
    if name == "victim_demographics":
        return R.victim_report(state("victim_counts"), t("dim_victim"), rows)
    if name == "weapon_distribution":
        return R.weapon_report(state("weapon_counts"), t("dim_time"), t("dim_area"), t("dim_weapon"), rows)
    raise KeyError(name)
