"""Stage timeline of one registered query from Spark's event log.

    python scripts/stages.py QUERY [SF_DIR]

Runs the query twice through the ``noop`` sink with the event log written to a
fresh scratch folder, then prints the second run's stages longer than 150 ms
(start, end, duration, task count). The Spark UI stays off.
"""

import glob
import io
import json
import os
import sys
import tempfile
import time

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans.star import QUERIES  # noqa: E402


def main() -> None:
    q = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    evdir = tempfile.mkdtemp(prefix="tidemark-evlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", evdir)
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10485760")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[q](spark, sf).write.format("noop").mode("overwrite").save()
    t0 = time.time()
    df = QUERIES[q](spark, sf)
    t1 = time.time()
    df.write.format("noop").mode("overwrite").save()
    print(f"build {t1 - t0:.2f}s run {time.time() - t1:.2f}s")
    app = spark.sparkContext.applicationId
    spark.stop()
    folder = [p for p in glob.glob(evdir + "/*") if app in p][0]
    files = sorted(glob.glob(folder + "/events_*")) if os.path.isdir(folder) else [folder]
    raw = b""
    for f in files:
        with open(f, "rb") as fh:
            data = fh.read()
        if f.endswith(".zstd"):  # several zstd frames: read across all of them
            data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        raw += data
    stages = {}
    for line in raw.decode().splitlines():
        e = json.loads(line)
        if e["Event"] == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            stages[i["Stage ID"]] = (i["Submission Time"], i["Completion Time"], i["Number of Tasks"], i["Stage Name"][:50])
    saves = [sid for sid, v in sorted(stages.items()) if v[3].startswith("save")]
    second = [(sid, v) for sid, v in sorted(stages.items()) if sid > saves[0]]
    base = min(v[0] for _, v in second)
    for sid, (sub, end, n, name) in second:
        if end - sub > 150:
            print(f"stage {sid:4d} start {sub - base:6d} end {end - base:6d} dur {end - sub:6d} ms {n:4d} tasks {name}")


if __name__ == "__main__":
    main()
