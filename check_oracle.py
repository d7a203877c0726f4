"""Run registered queries in Spark and their oracle SQL in DuckDB; print a table.

usage: python check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import sys
import time

from ledgerflow.plans.catalog import REGISTRY
from ledgerflow.plans.compare import compare, duckdb_connection
from ledgerflow.session import build_session


def main(argv: list[str]) -> int:
    sf = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    spark = build_session()
    con = duckdb_connection(sf)
    bad = 0
    for name, q in sorted(REGISTRY.items()):
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf)
            if q.sql is None:
                n = df.count()
                print(f"ROWS  {name:45s} rows={n} ({time.time() - t0:.1f}s) [no oracle]")
                continue
            out = compare(name, df, con, q.sql)
        except Exception as e:  # report and keep going
            bad += 1
            print(f"ERROR {name:45s} {type(e).__name__}: {str(e)[:400]}")
            continue
        bad += 0 if out.ok else 1
        tag = "OK   " if out.ok else "FAIL "
        print(f"{tag} {name:45s} rows={out.spark_rows}/{out.oracle_rows} ({time.time() - t0:.1f}s)"
              + ("" if out.ok else f"  {out.detail[:600]}"))
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
