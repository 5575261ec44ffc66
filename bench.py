"""Benchmark: run the registered queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect), after
one untimed warm-up pass of the flagship query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans.star import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(cpus) * 2))))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Data tables are joined as at scale: no broadcast from file-size
        # estimates; AQE may still broadcast a side whose measured shuffle
        # output is small. Bounded dimensions carry explicit hints.
        .config("spark.sql.autoBroadcastJoinThreshold", os.environ.get("BENCH_STATIC_BROADCAST_BYTES", "-1"))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", os.environ.get("BENCH_AQE_BROADCAST_BYTES", "10485760"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Untimed warm-up: one pass of the flagship query brings the JIT and the
    # file cache to a steady state before any query is timed.
    QUERIES["customer_week_mart"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
