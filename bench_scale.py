"""Scaling run: the star build and the five reports on the fixture replicated
k times (each copy gets its own report numbers), to show how time grows with
the data. Prints one JSON line per factor.

    BENCH_SF_DIR=/root/testdata/sf0.01 BENCH_SCALES=1,10,100 python bench_scale.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from blotter.plans import pipeline as P  # noqa: E402
from blotter.plans.queries import RUN_TS  # noqa: E402
from blotter.session import get_spark, scratch_path  # noqa: E402
from blotter.sources.fixture import incident_fixture  # noqa: E402
from blotter.sources.store import TableStore  # noqa: E402

# Report-number offset between copies. Fixture report numbers
# stay below one million up to sf1, so dr_no remains an int up to 2,000 copies.
COPY_OFFSET = 1_000_000


def replicated_fixture(spark, sf_dir: str, k: int):
    fx = incident_fixture(spark, sf_dir)
    if k == 1:
        return fx
    copies = fx.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return copies.withColumn(
        "dr_no", (F.col("dr_no").cast("long") + F.col("__copy") * COPY_OFFSET).cast("string")
    ).drop("__copy")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scales = [int(x) for x in os.environ.get("BENCH_SCALES", "1,10").split(",")]
    spark = get_spark(f"local[{cpus}]", app="blotter-scale", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    for k in scales:
        store = TableStore(spark, scratch_path(spark, f"scale-{k}"))
        t0 = time.time()
        P.load_raw(store, replicated_fixture(spark, sf_dir, k))
        star = P.run_models(spark, store, RUN_TS)
        times = {"star_build": time.time() - t0}
        for name in P.REPORTS:
            t = time.time()
            star.report(name).write.format("noop").mode("overwrite").save()
            times[name] = time.time() - t
        print(json.dumps({"scale": k, "incidents": star.rows["fct_incidents"],
                          "total_seconds": round(sum(times.values()), 3),
                          "queries": {q: round(v, 3) for q, v in times.items()}}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
