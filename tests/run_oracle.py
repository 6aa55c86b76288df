"""Run registered queries against DuckDB: ``python tests/run_oracle.py [sf] [name ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import connect, diff  # noqa: E402
from orbgrid.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
names = sys.argv[2:]
d = f"/root/testdata/{sf}"
spark = build_session(
    "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(d)
qs, sql = entry.queries(), entry.oracle_sql()
bad = 0
for name in names or qs:
    t = time.time()
    try:
        df = qs[name](spark, d)
        if name in sql:
            problem, n = diff(df, con, sql[name]), ""
        else:
            n = df.count()
            problem = None if n else "no rows"
    except Exception as e:  # noqa: BLE001
        problem = f"{type(e).__name__}: {str(e)[:1500]}"
    bad += problem is not None
    print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.2f}s {problem or ''}", flush=True)
print("queries", len(names or qs), "bad", bad, "without sql", sorted(set(qs) - set(sql)))
