"""Session construction and the shared folder used to cut lineage.

On a cluster the session arrives configured (``spark-submit`` / cluster
defaults); :func:`get_session` only fills in settings that are unset, so it is
safe to call from jobs and from tests alike.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when the session does not already define them.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    # keep CPU-heavy stages of small local inputs spread over the cores (cluster sessions keep their own)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def get_session(master: str | None = None, app_name: str = "callgrid",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, creating a local one for tests/bench if none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session; only when it is unset and the master is local (tests) a scratch
    folder is created and registered. On a cluster an unset folder is an error: executors
    would each write to a disk of their own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_callgrid_shared", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    # the setting itself cannot be changed in a running session, so the context keeps the folder
    context._callgrid_shared = tempfile.mkdtemp(prefix="callgrid-ckpt-")
    context.setCheckpointDir(context._callgrid_shared)
    return context._callgrid_shared


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts lineage through files that survive a
    lost executor, prunes columns for each later reader, and gives the planner real sizes."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` to tasks for all cores, however few row groups its file has. For narrow rows before work
    that costs far more a row than their shuffle."""
    spark = df.sparkSession
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, key)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

