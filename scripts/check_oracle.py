"""Run registered queries and compare each with its DuckDB SQL.

    python scripts/check_oracle.py [sf_dir] [--exact] [query ...]

Prints one JSON line per query (row counts, column match, value match, any
type differences) and a final count of mismatches; exit status 1 if any.
``--exact`` compares doubles without rounding.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    args = sys.argv[1:]
    exact = "--exact" in args
    args = [a for a in args if a != "--exact"]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from loomprep.plans import catalog
    from loomprep.plans.compare import compare
    from loomprep.session import build_session
    spark = build_session(8)
    bad = 0
    for name in args or sorted(catalog.QUERIES):
        t0 = time.perf_counter()
        try:
            df = catalog.QUERIES[name](spark, sf)
            if name in catalog.ORACLE:
                r = compare(df, catalog.ORACLE[name], sf, digits=17 if exact else 6)
            else:
                r = {"rows": df.count(), "match": "rows-only"}
        except Exception as exc:  # report and go on with the next query
            r = {"error": repr(exc)[:500], "match": False}
        bad += r.get("match") is False or "type_mismatch" in r
        print(json.dumps({"query": name, "sec": round(time.perf_counter() - t0, 2), **r}, default=str),
              flush=True)
    print(json.dumps({"mismatches": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
