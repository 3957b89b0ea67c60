"""Run registered queries against their SQL: python tests/run_check.py [name-part ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

from larkspur.plans import all_queries, all_sql  # noqa: E402
from larkspur.session import build_session  # noqa: E402

sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
spark = build_session("check", "local[8]", 8, {"spark.driver.memory": "12g"})
spark.sparkContext.setLogLevel("ERROR")
con = oracle.connect(sf)
queries, sqls = all_queries(), all_sql()
wanted = sys.argv[1:]
failed = 0
for name, fn in queries.items():
    if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
        continue
    start = time.time()
    try:
        df = fn(spark, sf)
        if name in sqls:
            note, n = oracle.differences(df, con, sqls[name]) or oracle.type_differences(df, con, sqls[name]), ""
        else:
            note, n = "", f"{df.count()} rows (no SQL)"
    except Exception as e:  # noqa: BLE001
        note, n = f"{type(e).__name__}: {" ".join(str(e).split())[:1500]}", ""
    failed += bool(note)
    print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - start:.2f}s {n}{note}", flush=True)
print("failed:", failed)
