"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Files of about this size come out of a rebalanced write.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A sketch buffer is a few KB, so a task can keep thousands of groups hashed
    # before it falls back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "eventmart", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master, where driver and executors
    are one process; anywhere else a missing setting is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None)
    if named:
        folder = named
    elif context.getCheckpointDir():
        return context.getCheckpointDir()
    elif context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="eventmart-")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one for the output of a single run."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
