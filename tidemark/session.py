"""Session helpers: scratch locations and lineage cuts.

Writes that must survive executor loss go under the shared folder the cluster
names in ``spark.checkpoint.dir``. Only when that setting is absent (local
tests) is a folder under the system temp dir chosen and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none and runs in local mode (tests) is a
    folder created and registered with ``SparkContext.setCheckpointDir``; a
    cluster session without the setting is refused rather than given a
    machine-local folder. The config itself cannot be changed at run time. Sessions without a SparkContext (Spark
    Connect) read the setting from the session conf.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder for this session")
        return path
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            # A machine-local folder is invisible to executors and lost with the driver.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for cluster runs")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder (never machine-local on a cluster)."""
    return os.path.join(shared_dir(spark), "tidemark", f"{name}-{uuid.uuid4().hex[:12]}")


# Remove the shuffle files of a query at its end; else they stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block remove their shuffle files when they are done, so a job of many steps holds the shuffles of one step on disk.

    A written table is read from its files, so nothing asks for these shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet (with writer ``options``) under the shared folder and read it back.

    Used for a frame several consumers share (the weekly spine). Unlike an
    eager RDD checkpoint it is computed once, and each consumer's read is a
    columnar scan with its own column pruning and filter pushdown. The files
    live in shared storage, so a lost executor does not lose them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return spark.read.parquet(path)


# Settings for a large cluster run (~100 TB of sources). AQE sizes shuffle
# partitions from measured map output (start high, coalesce to ~256 MB), splits
# skewed join partitions, and may broadcast a side whose measured size is
# small; scan splits of 256 MB keep the task count in the hundreds of thousands.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "268435456",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "268435456",
    "spark.sql.shuffle.partitions": "20000",
}


def apply_scale_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Set ``SCALE_CONF`` keys the deployer has not set explicitly."""
    explicit = dict(spark.sparkContext.getConf().getAll())
    for key, value in {**SCALE_CONF, **(overrides or {})}.items():
        if key not in explicit:
            spark.conf.set(key, value)
