"""Spark session and shared-folder helpers.

Every job that cuts lineage writes under the folder named by the session's
``spark.checkpoint.dir``. On a cluster that setting names shared storage and is
taken as given; a private temporary folder is only created when the setting is
missing and Spark runs in local mode (tests, the bench).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"

# Settings every job of the mart relies on: UTC wall clock, ANSI casts (bad
# input fails like the warehouse casts do), adaptive execution with skew-join
# splitting for the few shuffled joins, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Always read bucketed tables bucket by bucket, so a rewrite of a bucketed
    # table keeps one bucket per task (no reshuffle before the bucketed write).
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # A join on several keys may use a layout on some of them: a MERGE into a
    # bridge (report number and code) streams the table's buckets (report number).
    CO_PARTITION: "false",
    # The JVM never compiles a method of more than 8,000 bytes of bytecode. The
    # wide projections of the mart (raw columns, staging, merges) become longer
    # ones when a whole stage is generated as one method, and then run
    # interpreted; beyond this limit Spark generates each operator by itself.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "blotter",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or a folder already given to the context).
    Only a local-mode session without that setting gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
        configured = tempfile.mkdtemp(prefix="blotter-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared folder, unique per call."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "blotter", *parts, uuid.uuid4().hex[:12]])


def conform_session(spark: SparkSession) -> None:
    """Apply the settings the models depend on to a session made elsewhere."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.sources.bucketing.autoBucketedScan.enabled",
              CO_PARTITION,
              "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(k, BASE_CONF[k])
    ensure_checkpoint_dir(spark)
