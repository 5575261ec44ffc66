"""Print physical-plan facts per query: exchanges, join kinds, scans."""
import sys, re, io, contextlib
sys.path.insert(0, ".")
from pyspark.sql import SparkSession
from tidemark.plans.star import QUERIES
sf = "/root/testdata/sf0.1"
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "16").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
names = sys.argv[1:] or [n for n in QUERIES if "roundtrip" not in n]
for n in names:
    df = QUERIES[n](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    kinds = {k: len(re.findall(k, plan)) for k in ["Exchange hashpartitioning", "Exchange SinglePartition", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "FileScan"]}
    print(n, {k: v for k, v in kinds.items() if v})
    if "-v" in sys.argv[0:1] or len(sys.argv) == 2:
        print(plan)
