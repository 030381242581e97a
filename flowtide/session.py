"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "flowtide", **overrides: str) -> SparkSession:
    """Session with the settings above; pass e.g. ``**{"spark.sql.shuffle.partitions": "8"}`` to add more."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: the cluster's ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a folder of its own beside the warehouse, removed when Python ends; only there
    driver and executors share one disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    os.makedirs(warehouse, exist_ok=True)
    fallback = tempfile.mkdtemp(prefix="flowtide-scratch-", dir=warehouse)
    atexit.register(shutil.rmtree, fallback, ignore_errors=True)
    context.setCheckpointDir(fallback)
    return fallback


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems; a missing one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of all files behind paths, which may be patterns."""
    total = 0
    for path in paths:
        system, place = _located(spark, path)
        total += sum(system.getContentSummary(found.getPath()).getLength() for found in system.globStatus(place) or [])
    return total


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    system, place = _located(spark, path)
    system.create(place, True).close()


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; a missing one has none."""
    system, place = _located(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, writing to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
