"""Markdown table of physical-plan facts for every registered query (initial plan)."""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans.star import QUERIES  # noqa: E402

KINDS = [
    ("Exchange hashpartitioning", "hash exch."),
    ("Exchange SinglePartition", "single exch."),
    ("BroadcastExchange", "bcast exch."),
    ("SortMergeJoin", "SMJ"),
    ("BroadcastHashJoin", "BHJ"),
    ("BroadcastNestedLoopJoin", "BNLJ"),
    ("CartesianProduct", "cartesian"),
    ("Window", "window"),
    ("HashAggregate", "hash agg"),
    ("SortAggregate", "sort agg"),
    ("ObjectHashAggregate", "obj agg"),
    ("FileScan", "scans"),
]
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = (
    SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "16")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
print("| query | " + " | ".join(k[1] for k in KINDS) + " |")
print("|---" * (len(KINDS) + 1) + "|")
for name, fn in QUERIES.items():
    plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
    counts = [len(re.findall(re.escape(k[0]) + r"\b", plan)) for k in KINDS]
    print(f"| `{name}` | " + " | ".join(str(c) if c else "·" for c in counts) + " |")
