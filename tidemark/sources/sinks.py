"""The mart sink.

Partitioned by week; an overwrite replaces only the weeks present in the
written frame (dynamic partition overwrite), so re-running a week is
idempotent and other weeks stay. New columns are allowed: reading with
``mergeSchema`` gives NULL for them in older weeks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import WEEK


def write_weeks(df: DataFrame, path: str, week: str = WEEK) -> None:
    """Dynamic partition overwrite of the weeks present in ``df``.

    The ``rebalance`` hint clusters rows by week before the write so each task
    writes few week folders (no files × weeks explosion), and lets AQE split a
    large week over several tasks and merge small ones, so one week holding
    most of the rows does not become one task.
    """
    (
        df.hint("rebalance", week)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(week)
        .parquet(path)
    )


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
