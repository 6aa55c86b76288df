"""Session settings the library is designed for."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys in sort-merge joins are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose small side turns out small are switched to broadcast from
    # the measured shuffle size, never from an estimate alone.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Sides that are already partitioned by a part of the join keys stay put.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Arrow batches for the one place user Python runs (block reducers).
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "orbgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """A new folder for intermediate tables, in the cluster's shared folder.

    That is ``spark.checkpoint.dir`` of the session.  Only a local session
    without the setting gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/orbgrid-{os.urandom(8).hex()}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="orbgrid-")


def lineage_cutter(spark: SparkSession) -> Callable[..., DataFrame]:
    """A function that stores a DataFrame reliably and returns it without its history."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return lambda df, *_: df.checkpoint()


def keep_copartitioning(spark: SparkSession) -> None:
    """Let joins use a partitioning by a part of their keys.

    Spark would otherwise shuffle both sides again by all keys.  Plans that
    place their rows themselves rely on it, whoever made the session.
    """
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(key, SETTINGS[key])
