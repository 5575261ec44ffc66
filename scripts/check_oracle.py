"""Compare each Spark query with its DuckDB oracle: rows, column names, values."""
import sys, time, math
sys.path.insert(0, ".")
import duckdb
import pandas as pd
from pyspark.sql import SparkSession
from tidemark.plans.star import QUERIES
from tidemark.plans.oracle_sql import ORACLE_SQL

sf = "/root/testdata/sf0.01"
names = sys.argv[1:] or list(QUERIES)
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
con = duckdb.connect()
for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")

def norm(v):
    if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
        return None
    if isinstance(v, float) and v == int(v):
        return int(v)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v

def canon(df):
    cols = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))

ok = 0
for n in names:
    t = time.time()
    try:
        s = QUERIES[n](spark, sf).toPandas()
        sql = ORACLE_SQL.get(n)
        if sql is None:
            print(f"{n:24s} rows-only {len(s)}"); continue
        d = con.execute(sql).df()
        sc, sr = canon(s); dc, dr = canon(d)
        status = "MATCH" if (sc == dc and sr == dr) else "DIFF"
        ok += status == "MATCH"
        print(f"{n:24s} {status} spark={len(s)} duck={len(d)} {time.time()-t:.1f}s", flush=True)
        if status == "DIFF":
            if sc != dc:
                print("   cols spark-only", set(sc) - set(dc), "duck-only", set(dc) - set(sc))
            else:
                diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
                for a, b in diff:
                    print("   spark", a); print("   duck ", b)
        print("   types:", {c: str(s[c].dtype) for c in s.columns if str(s[c].dtype) != str(d[c].dtype) } if sc == dc else "", 
              {c: str(d[c].dtype) for c in d.columns if c in s.columns and str(s[c].dtype) != str(d[c].dtype)} if sc == dc else "")
    except Exception as e:
        print(f"{n:24s} FAILED {type(e).__name__}: {str(e)[:600]}", flush=True)
print("matched", ok)
