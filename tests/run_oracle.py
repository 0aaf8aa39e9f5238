"""Command line check: python tests/run_oracle.py [sf_dir] [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidewater.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    con = oracle.connect(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(qs)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = qs[n](spark, sf)
            msg = oracle.compare(df, con, sqls[n]) if n in sqls else f"rows only: {df.count()}"
        except Exception as ex:  # noqa: BLE001
            msg = "ERROR " + str(ex)[:1500]
        ok = msg is None or msg.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {n} {time.time() - t:.2f}s {msg or ''}", flush=True)
    print("bad:", bad)
    spark.stop()
