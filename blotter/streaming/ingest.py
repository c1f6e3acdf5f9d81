"""Landing-folder ingest as a Structured Streaming query.

New CSV files in the landing folder are picked up exactly once (the stream's
checkpoint records which files were read), each micro-batch is stamped with
its load time and MERGEd into the raw table, then the models advance. With
``trigger(availableNow=True)`` a scheduled run drains what has arrived and
stops, like the batch loader; the checkpoint lives in the shared folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from blotter.plans.pipeline import RAW, load_raw, run_models
from blotter.session import scratch_path
from blotter.sources.landing import landing_options, landing_schema, null_tokens, split_landed, with_load_ts
from blotter.sources.store import TableStore


QUARANTINE = "landing_rejected"


def landing_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                   keep_bad: bool = False) -> DataFrame:
    """The landing folder as a stream, in the same format and with the same
    checks as the batch scan (a header with other columns fails the query)."""
    reader = landing_options(spark.readStream.schema(landing_schema(keep_bad=keep_bad)), keep_bad)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return null_tokens(reader.csv(folder))


def ingest_available(spark: SparkSession, folder: str, store: TableStore,
                     checkpoint: str | None = None, clock=None,
                     advance_models: bool = True, keep_bad: bool = False) -> list[str]:
    """Drain the landing folder once; return the load stamps used.

    A bad row fails the query, or with ``keep_bad`` is written to
    ``raw.landing_rejected`` with its reasons and load stamp; the good rows of
    its file are loaded.

    ``clock`` returns the load time of a micro-batch (defaults to the current
    UTC time truncated to seconds); one stamp per micro-batch.
    """
    clock = clock or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0))
    stamps: list[str] = []

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        stamp = clock().isoformat(sep=" ")
        if keep_bad:
            batch, bad = split_landed(batch)
            known, bad = store.read(RAW, QUARANTINE), with_load_ts(bad, stamp)
            store.write(bad if known is None else known.unionByName(bad), RAW, QUARANTINE)
        load_raw(store, with_load_ts(batch, stamp))
        if advance_models:
            run_models(spark, store, stamp)
        stamps.append(stamp)

    q = (landing_stream(spark, folder, keep_bad=keep_bad).writeStream
         .foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "ingest-checkpoint"))
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return stamps
