"""Run catalogue queries against their DuckDB oracles: python tools_check.py [sf_dir] [names...]"""

import sys
import time

from orderpulse.plans.catalogue import ORACLES, QUERIES
from orderpulse.plans.compare import compare, duckdb_connection
from orderpulse.session import get_spark

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = get_spark("local[8]")
con = duckdb_connection(sf_dir)
bad = 0
for n in names:
    t = time.time()
    try:
        df = QUERIES[n](spark, sf_dir)
        if n in ORACLES:
            ok, msg = compare(df, ORACLES[n], con)
        else:
            ok, msg = True, f"no oracle, {df.count()} rows"
    except Exception as e:  # report and continue
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {n:40s} {time.time() - t:6.2f}s {msg}", flush=True)
print("failures:", bad)
