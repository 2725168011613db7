"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Set only where the job owns the session.  Skew joins and partition coalescing are what the
# operators count on; ``forceOptimizeSkewedJoin`` lets a hot join key be split even when the
# next step groups by the same key.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_scratch: str | None = None


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared folder (``spark.checkpoint.dir``).

    Executors on other machines, and retries after an executor is lost, must see what is written
    there, so a machine-local folder is used only by a local master without the setting.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="driftwell-")
        base = _local_scratch
    return f"{base.rstrip('/')}/driftwell/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a path on whatever file system it names; one that is absent is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch path for the length of a block; what was written there is deleted at its end."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        delete_path(spark, path)
