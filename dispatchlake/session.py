"""Session settings and the shared scratch area.

Nothing here creates a session: jobs, tests and the bench pass theirs in.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Event times carry no zone on the wire, so days and hours are cut in UTC everywhere.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows go to Python by weight, not by number: a batch of long texts stays small.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job relies on to an existing session."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can read and that outlives any one of them.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session (tests) may fall back
    to a temporary folder; on a cluster that would lose data with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="dispatchlake-")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared one."""
    return f"{shared_dir(spark)}/dispatchlake/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that survives executor loss, and pins values that a recomputation
    could change (partition numbers, for instance).
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
