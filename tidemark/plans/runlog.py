"""Run log and pending-week selection as DataFrame operations.

The log has one row per (week, process, table) run. A missing log is an empty
frame (no sentinel row, Q16), so the first run proceeds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from tidemark import WEEK
from tidemark.sources.catalog import path_exists

LOG_SCHEMA = StructType(
    [
        StructField(WEEK, IntegerType(), False),
        StructField("start_time", TimestampType(), True),
        StructField("end_time", TimestampType(), True),
        StructField("elapsed_seconds", DoubleType(), True),
        StructField("process_name", StringType(), True),
        StructField("table_name", StringType(), True),
    ]
)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    return spark.createDataFrame([], LOG_SCHEMA)


def _done(log: DataFrame, process: str | None, table: str | None) -> DataFrame:
    if process is not None:
        log = log.filter(F.col("process_name") == process)
    if table is not None:
        log = log.filter(F.col("table_name") == table)
    return log.select(WEEK)


def pending_weeks(requested: DataFrame, log: DataFrame, process: str | None = None, table: str | None = None) -> DataFrame:
    """Requested weeks with no log row (anti join)."""
    return requested.select(WEEK).distinct().join(_done(log, process, table), WEEK, "left_anti")


def pending_after_high_water(requested: DataFrame, log: DataFrame, process: str | None = None, table: str | None = None) -> DataFrame:
    """Requested weeks above the highest logged week (all when the log is empty).

    The high-water mark is a scalar subquery, not a join."""
    hwm = _done(log, process, table).agg(F.max(WEEK)).scalar()
    return requested.select(WEEK).distinct().filter(F.col(WEEK) > F.coalesce(hwm, F.lit(-(2**31))))


def append_log(
    spark: SparkSession,
    path: str,
    weeks: list[int],
    start: dt.datetime,
    end: dt.datetime,
    process: str,
    table: str,
) -> None:
    """I4: one row per written week (the only rows built on the driver: metadata)."""
    secs = (end - start).total_seconds()
    rows = [(int(w), start, end, secs, process, table) for w in weeks]
    spark.createDataFrame(rows, LOG_SCHEMA).write.mode("append").parquet(path)
