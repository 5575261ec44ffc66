"""Run every registered query and print row count, schema and time."""
import sys, time
sys.path.insert(0, ".")
from pyspark.sql import SparkSession
from tidemark.plans.star import QUERIES

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
for n in names:
    t = time.time()
    try:
        df = QUERIES[n](spark, sf)
        rows = df.count()
        print(f"{n:24s} rows={rows:8d} {time.time()-t:6.2f}s  {df.schema.simpleString()[:300]}", flush=True)
    except Exception as e:
        print(f"{n:24s} FAILED {type(e).__name__}: {str(e)[:800]}", flush=True)
