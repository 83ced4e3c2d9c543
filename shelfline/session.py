"""Session settings the engine is written for, and the folder its jobs share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The size a large date or a skewed join is split to, and so about that of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keyed stream state lives on executor disk, not in the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of one write."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="shelfline-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may do without the setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir(spark.sparkContext.applicationId)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing was written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def at_once(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """The results of jobs that don't need each other, submitted together: tasks of one run on the cores that the last tasks of
    another leave idle. If one fails, the others end before its error is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in begun]
