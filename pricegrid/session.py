"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name="pricegrid", master=None, shuffle_partitions=None, extra=None):
    """Session with the settings above; cluster settings win where already set."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in (extra or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark, purpose):
    """A new folder below the cluster's shared spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="pricegrid-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def lineage_dir(spark):
    """Make sure that iterative estimators can cut their lineage by checkpoints."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark, "lineage"))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning, _before = Lock(), []


@contextmanager
def shuffles_removed(spark):
    """Shuffle files of the queries that run meanwhile are removed when these end.

    Spark else keeps them until the driver happens to collect its garbage. Threads may
    overlap: the first one in keeps the setting, the last one out restores it.
    """
    with _cleaning:
        _before.append(_before[0] if _before else spark.conf.get(CLEANUP, None))
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning:
            was = _before.pop()
            if not _before:
                spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)


def stage(df, name):
    """Write a table to the shared folder and read it back (cuts the lineage).

    What was shuffled for it is not needed again, so it does not lie beside the table.
    """
    path = shared_dir(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(df, *columns):
    """The given columns (or all), written once because an operator reads them
    several times: later passes scan a slim table instead of repeating joins."""
    return stage(df.select(*columns) if columns else df, "input")
