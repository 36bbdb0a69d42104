"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: str | None = None


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is written for.

    Wall-clock timestamps are zone-less everywhere, so the zone is pinned only to make
    `current_timestamp` and zone-aware input repeatable.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a single-machine session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="meterline-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_root(spark)}/meterline/{label}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new catalog database whose managed tables live in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{workspace(spark, label)}'")
    return name
