"""Run every catalog query in Spark and its oracle SQL in DuckDB; report matches.

usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tests"))

from oracle_util import compare, duckdb_conn  # noqa: E402

from transitlens.plans.catalog import QUERIES  # noqa: E402
from transitlens.plans.oracle import oracle_sql  # noqa: E402
from transitlens.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb_conn(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for n in names:
        t = time.time()
        try:
            r = compare(QUERIES[n](spark, sf_dir), con, sqls[n]) if n in sqls else {"ok": None}
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "error": repr(e)[:1500]}
        r["sec"] = round(time.time() - t, 2)
        bad += r.get("ok") is False
        print(n, json.dumps(r, default=str)[:3000], flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
