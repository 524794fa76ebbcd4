"""Run registered queries against their DuckDB oracle (python tests/oracle_run.py [sf_dir] [names…])."""
import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from eventide.plans.compare import compare, duckdb_conn  # noqa: E402
from eventide.plans.oracle import ORACLE  # noqa: E402
from eventide.plans.registry import QUERIES  # noqa: E402
from eventide.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb_conn(sf)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = QUERIES[n](spark, sf)
            r = compare(df, con, ORACLE[n]) if n in ORACLE else {"match": None, "rows": df.count()}
        except Exception as e:  # report and continue
            r = {"match": False, "error": repr(e)[:600]}
        r["sec"] = round(time.time() - t, 2)
        ok = r.get("match")
        bad += ok is False
        print(("OK  " if ok else "--  " if ok is None else "BAD ") + n, json.dumps(r, default=str)[:900],
              flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
