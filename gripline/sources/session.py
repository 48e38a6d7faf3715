"""Session settings and the one way used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# many small files: a few tasks list them, opening one counts for 64 kB and not for 4 MB of what a task reads, and no listing is kept
FEW_TASKS = {
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.files.openCostInBytes": "65536",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a local session without one gets a fresh one, a cluster raises."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="gripline-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def settle(rows: DataFrame) -> DataFrame:
    """Write rows to the checkpoint folder once, for results that several later steps read."""
    checkpoint_folder(rows.sparkSession)
    return rows.checkpoint()


def few_tasks(spark: SparkSession) -> SparkSession:
    """A session with the settings of `spark` for many small files: the driver keeps a record of every task, and a task for each file fills it."""
    session = spark.newSession()
    for name, value in (spark.conf.getAll | FEW_TASKS).items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session
