"""Session settings the package relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Semantics, not tuning: stamps are UTC, and rewriting a block leaves the others in place.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Runtime re-planning: coalesced shuffles, split skewed joins.
_ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options the operators need on an existing session."""
    for key, value in {**_REQUIRED, **_ADAPTIVE}.items():
        spark.conf.set(key, value)
    return spark


def session(master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session, for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("gridspark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**_REQUIRED, **_ADAPTIVE}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors see.

    A session within one machine (tests) that has none gets a folder of its own; a cluster is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gridspark-"))
    return context.getCheckpointDir().rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder path for written intermediate tables, in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
