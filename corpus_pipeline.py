"""The corpus pipeline: documents in, packed training batches out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blotter.llm import stages
from blotter.llm.common import cut, read

#: (name, function of (spark, docs, sf_dir)); each works on all rows that the
#: one before it returned.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = stages.STAGES

#: A classifier fitted by gradient descent is not SQL; tests hold the pipeline
#: against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; every result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
