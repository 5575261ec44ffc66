import sys, time
sys.path.insert(0, ".")
from pyspark.sql import SparkSession
from tidemark.plans.star import Star
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "16").config("spark.driver.memory", "16g").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
s = Star(spark, sf)
def run(name, f, reps=2):
    best = 1e9
    for _ in range(reps):
        t = time.perf_counter(); df = f(); t1 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save(); t2 = time.perf_counter()
        best = min(best, t2 - t)
    print(f"{name:16s} build={t1-t:6.2f}s total={best:6.2f}s", flush=True)
run("warmup", s.spine)
for n in ["spine", "lineitem_pass", "events_pass", "pipeline", "eligibility", "billing", "offers", "set_top_box", "journey", "line_speed", "reward_claims", "downloads", "mart"]:
    run(n, getattr(s, n))
