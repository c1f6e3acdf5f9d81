"""Seed lookups shipped with the package.

* ``mocodes.csv``: our own small modus-operandi list (codes 100-199 without the
  multiples of 7, 300-339 without the multiples of 5; text ``MO <code>, ...``),
  zero-padded like the source codes.
* ``descent_mapping.csv``: the 19 victim descent codes of the public field
  description.

Both are bounded by construction (fixed files), so they are broadcast freely.
The packaged files are parsed on the driver and travel with the plan (the
package folder need not exist on executors); a seed on shared storage is read
by Spark's CSV scan.
"""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import DESCENT_SEED_SCHEMA, MOCODE_SEED_SCHEMA

SEED_DIR = os.path.join(os.path.dirname(os.path.abspath(__file__)), "seed_data")
SEEDS = {
    "mocodes": ("mocodes.csv", MOCODE_SEED_SCHEMA),
    "descent_mapping": ("descent_mapping.csv", DESCENT_SEED_SCHEMA),
}


def seed_path(name: str) -> str:
    return os.path.join(SEED_DIR, SEEDS[name][0])


def _packaged_rows(fname: str, schema) -> list[tuple]:
    casts = [int if f.dataType.simpleString() == "int" else str for f in schema.fields]
    out = []
    with open(os.path.join(SEED_DIR, fname), newline="", encoding="utf-8") as fh:
        reader = csv.reader(fh, quotechar='"', doublequote=True)
        next(reader)
        for rec in reader:
            vals = [None if v == "" else c(v) for c, v in zip(casts, rec)]
            out.append(tuple(vals + [None] * (len(casts) - len(vals))))
    return out


def load_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Typed seed table. Records whose first (code) column is null are
    rejected: a description split over two lines must not become a code-less
    row."""
    fname, schema = SEEDS[name]
    if path:
        df = (spark.read.schema(schema).option("header", True).option("quote", '"')
              .option("escape", '"').option("mode", "FAILFAST").csv(path))
    else:
        df = spark.createDataFrame(_packaged_rows(fname, schema), schema)
    return df.filter(F.col(schema.fields[0].name).isNotNull())
