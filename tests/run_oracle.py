"""Compare every registered query with its oracle SQL: python -m tests.run_oracle [sf_dir] [names...]"""
import sys
import time

sys.path.insert(0, ".")
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from stayframe.session import build_session  # noqa: E402
from tests.harness import compare, duck  # noqa: E402

d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
import os  # noqa: E402
if os.environ.get("ORACLE_PLAIN"):
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
else:
    import tempfile  # noqa: E402
    spark = build_session("local[8]", 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="stayframe-oracle-")})
if os.environ.get("ORACLE_TZ"):
    spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
con = duck(d)
qs, orc = queries(), oracle_sql()
bad = 0
for name, fn in qs.items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, d)
        if name in orc:
            ok, msg = compare(df, con, orc[name])
        else:
            n = df.count()
            ok, msg = True, f"rows-only {n}"
    except Exception as e:  # report and continue
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.2f}s {msg}", flush=True)
print("failures:", bad)
