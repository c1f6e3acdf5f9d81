"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each timing runs the query to completion through the
``noop`` sink (every row produced, nothing collected to the driver).

* ``star_build``: land the fixture, merge it into the raw table and build
  every dimension, the snapshot, both bridges and the fact (written tables);
* ``incremental_3batch``: the same mart advanced by three incremental loads
  of the change feed;
* the five reports over the built mart, the mart's declared check suite, the
  data checks and monitors, and the landing CSV scan.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blotter.checks.suite import mart_checks  # noqa: E402
from blotter.plans import pipeline as P  # noqa: E402
from blotter.plans import queries as Q  # noqa: E402
from blotter.session import get_spark  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # One shuffle partition (and table bucket) per core at this data size;
    # BENCH_PARTITIONS overrides.
    partitions = int(os.environ.get("BENCH_PARTITIONS", cpus))
    spark = get_spark(f"local[{cpus}]", app="blotter-bench", shuffle_partitions=partitions,
                      extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}

    # Warm the JVM on a tiny scan so the first timed query does not pay for it.
    run(Q.read_table(spark, sf_dir, "nation"))

    t = time.time()
    star = Q.full_star(spark, sf_dir)
    times["star_build"] = time.time() - t

    for name in P.REPORTS:
        t = time.time()
        run(star.report(name))
        times[name] = time.time() - t

    t = time.time()
    run(mart_checks(star))
    times["mart_checks"] = time.time() - t

    t = time.time()
    Q.batch_star(spark, sf_dir)
    times["incremental_3batch"] = time.time() - t

    for name in ["check_not_null", "check_unique", "check_relationship_fact_dims",
                 "check_relationship_lineitem_orders", "volume_anomalies_daily",
                 "freshness_anomalies_daily", "column_anomalies_value", "landing_csv_scan",
                 "stg_incidents"]:
        t = time.time()
        run(Q.queries()[name](spark, sf_dir))
        times[name] = time.time() - t

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
