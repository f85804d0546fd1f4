"""Session defaults and the shared folder that jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "ledgerlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    ``conf`` takes Spark keys with ``__`` for the dots. Settings already given to the session are
    not overridden on a cluster: pass them at submit time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, whose executors share this machine, may name none; it gets a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} names no folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, name: str) -> str:
    """A fresh database below the shared folder."""
    path = scratch(spark, name)
    database = path.rsplit("/", 1)[1].replace("-", "_")
    return open_database(spark, database, path)


def open_database(spark: SparkSession, name: str, location: str) -> str:
    """The database of this name, made at ``location`` if the session's catalog has none."""
    where = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{where}'")
    return name


def default_parallelism() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
