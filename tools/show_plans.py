"""Print condensed physical plans (operator tree, no attributes) of the jobs
that matter at scale: the fact build, the co-partitioned reports and the
incremental merges. Usage: python tools/show_plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blotter.operators.merge import merge_upsert, sync_columns  # noqa: E402
from blotter.plans import pipeline as P  # noqa: E402
from blotter.plans import queries as Q  # noqa: E402
from blotter.plans.fact import fct_incidents  # noqa: E402
from blotter.session import get_spark  # noqa: E402
from blotter.sources.seeds import load_seed  # noqa: E402

KEEP = re.compile(r"(Exchange \w+|BroadcastHashJoin|SortMergeJoin|BroadcastExchange|HashAggregate|"
                  r"ObjectHashAggregate|SortAggregate|Window|FileScan parquet|Generate|Union|Sort |"
                  r"Project|Filter|Range|Scan ExistingRDD|LocalTableScan)")


def condensed(df) -> str:
    lines = []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        m = KEEP.search(line)
        if not m:
            continue
        indent = line[:m.start()]
        text = m.group(0).strip()
        if text.startswith("Exchange"):
            ex = re.match(r"Exchange (\w+)(?:\(([^,)]*))?", line[m.start():])
            text = f"Exchange {ex.group(1)}" + (f" ({ex.group(2)})" if ex.group(2) else "")
        if text == "FileScan parquet":
            bucketed = "bucketed" if "Bucketed: true" in line else "plain"
            name = re.search(r"FileScan parquet (\S+?)\[", line)
            text += f" {name.group(1).split('.')[-1] if name else ''} ({bucketed})"
        if text in ("Project", "Filter"):
            continue
        lines.append(indent + text)
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_spark("local[4]", shuffle_partitions=8)
    # Plan as for large tables: no size-estimate broadcasts, only the explicit
    # size-checked ones.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    star = Q.batch_star(spark, sf)
    dims = {n: star.table(n) for n in P.CORE_TABLES if n.startswith("dim_")}
    shows = {
        "fact build (one map-only stage)": fct_incidents(
            star.stg(), dims, load_seed(spark, "descent_mapping"), Q.RUN_TS, star.rows),
        "crime_code_seasonality": star.report("crime_code_seasonality"),
        "victim_demographics": star.report("victim_demographics"),
    }
    fact = star.table("fct_incidents")
    inc = star.store.read(P.INCREMENTS, "fct_incidents")      # the last run's staged increment
    n = star.store.rows(P.INCREMENTS, "fct_incidents")
    keep = [c for c in fact.columns if c not in ("dr_no", "doe")]
    shows["incremental fact merge, small increment (broadcast plan)"] = merge_upsert(
        sync_columns(fact, inc), inc, ["dr_no"], update_cols=keep, source_rows=n,
        check_unique=False, insert_partitioning=(star.store.buckets, ["dr_no"]))
    shows["incremental fact merge, large increment (full outer plan)"] = merge_upsert(
        sync_columns(fact, inc), inc, ["dr_no"], update_cols=keep, source_rows=n,
        check_unique=False, broadcast_rows=0)
    for title, df in shows.items():
        print(f"--- {title}\n{condensed(df)}\n")


if __name__ == "__main__":
    main()
