"""Spark session and the folder that all executors share."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Spark's default (INT96) has no minimum and maximum, so no row group could be skipped by time.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app: str = "starmart", master: str | None = None, **extra: str) -> SparkSession:
    """Session for the jobs. Sizing (executors, memory, shuffle partitions) is left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run_together(*jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs at the same time, so that small ones do not idle the cluster."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


_CHOICE = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset, one in the warehouse.

    On a cluster the warehouse must have been named too: its default is a folder of the driver's own machine.
    """
    context = spark.sparkContext
    with _CHOICE:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if named is None:
            alone = context.master.startswith("local") and not context.master.startswith("local-cluster")
            if not alone and not context.getConf().contains("spark.sql.warehouse.dir"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
            named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/starmart/{label}-{uuid.uuid4().hex}"
