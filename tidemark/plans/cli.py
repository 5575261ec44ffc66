"""Command-line run: build every pending week of a range in one Spark job.

    spark-submit -m tidemark.plans.cli --data DIR --mart DIR --log DIR --from 199601 --to 199652

Pending weeks are the base's weeks in the range without a log row for
(process, table); they are built together, written with dynamic partition
overwrite, and logged after the write succeeds. A re-run is a no-op.

    spark-submit -m tidemark.plans.cli --data DIR --mart DIR --refresh

rebuilds instead, over all weeks, those whose sources differ from the last published run (``plans/refresh.py``); the mart
folder then holds versions, read through ``sources/versions.py``.

``--vocab`` names a table of category values in shared storage. Each run adds the values that its
weeks bring; columns once written stay, and a new value gives a new column.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.functions.calendar import week_list
from tidemark.plans.mart import run
from tidemark.plans.refresh import refresh
from tidemark.plans.star import Star
from tidemark.session import apply_scale_conf
from tidemark.sources.catalog import path_exists

PROCESS = "weekly_mart"


def main(argv: list[str] | None = None) -> list[int]:
    ap = argparse.ArgumentParser(description="build pending weeks of the weekly mart")
    ap.add_argument("--data", required=True, help="folder with the source Parquet tables")
    ap.add_argument("--mart", required=True, help="output folder of the week-partitioned mart")
    ap.add_argument("--log", help="run-log folder")
    ap.add_argument("--from", dest="lo", type=int, help="first week YYYYWW")
    ap.add_argument("--to", dest="hi", type=int, help="last week YYYYWW")
    ap.add_argument("--refresh", action="store_true", help="keep the mart by versions and rebuild every week whose sources have changed")
    ap.add_argument("--table", default="mart", help="logical name of the mart in the log")
    ap.add_argument("--vocab", help="table of stored category values, in shared storage; each run adds to it")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark-weekly-mart").getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        apply_scale_conf(spark)  # cluster sizing; local sessions keep their own
    if a.refresh:
        done = refresh(spark, lambda **kw: Star(spark, a.data, **kw), a.mart, PROCESS, a.table)
        print(f"weeks written: {done}")
        return done
    if a.log is None or a.lo is None or a.hi is None:
        ap.error("--log, --from and --to are needed without --refresh")
    # Only the span's own dates are read to list its weeks.
    requested = week_list(Star(spark, a.data, span=(a.lo, a.hi)).spine(), a.lo, a.hi)

    built: list[Star] = []

    def build(weeks: list[int]):
        built.append(Star(spark, a.data, weeks, _stored_vocab(spark, a.vocab)))
        return built[-1].mart()

    done = run(spark, build, requested, a.mart, a.log, PROCESS, a.table)
    if a.vocab and done:  # only after the mart holds the columns
        _add_vocab(spark, a.vocab, built[-1].vocab("part", "lineitem", "events", "journey"))
    print(f"weeks written: {done}")
    return done


def _stored_vocab(spark: SparkSession, path: str | None) -> dict[str, dict[str, list[str]]]:
    """Category values of earlier runs (as many as the mart has category columns)."""
    out: dict[str, dict[str, list[str]]] = {}
    if path and path_exists(spark, path):
        for r in spark.read.parquet(path).distinct().orderBy("source", "column", "value").collect():
            out.setdefault(r["source"], {}).setdefault(r["column"], []).append(r["value"])
    return out


def _add_vocab(spark: SparkSession, path: str, vocab: dict[str, dict[str, list[str]]]) -> None:
    """Append the values that the table does not hold yet."""
    rows = [(s, c, v) for s, cols in vocab.items() for c, values in cols.items() for v in values]
    new = spark.createDataFrame(rows, "source string, column string, value string")
    if path_exists(spark, path):
        new = new.join(spark.read.parquet(path), ["source", "column", "value"], "left_anti")
    new.coalesce(1).write.mode("append").parquet(path)


if __name__ == "__main__":
    main()
