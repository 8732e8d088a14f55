"""Print a compact summary of the physical plan of registered queries:
the operators that move data (exchanges, joins, windows, aggregates,
top-k) in plan order, with the scan's read schema.

    python scripts/plan_summary.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Exchange", "BroadcastExchange", "Join", "Window", "WindowGroupLimit", "HashAggregate",
        "ObjectHashAggregate", "TakeOrderedAndProject", "Generate", "FileScan", "ArrowEvalPython",
        "BatchEvalPython", "Sort ", "Union")


def physical_plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue().split("== Physical Plan ==", 1)[1]


def summarize(df) -> list[str]:
    plan = physical_plan(df)
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        depth = (len(line) - len(line.lstrip(" :+-"))) // 3
        text = line.strip(" :+-")
        text = re.sub(r"#\d+L?", "", text)
        if text.startswith("FileScan"):
            m = re.search(r"ReadSchema: (struct<[^>]*>)", text)
            name = re.search(r"\[file:[^\]]*/([^/\]]+)\]", text)
            text = f"Scan {name.group(1) if name else ''} {m.group(1) if m else ''}"
        text = re.sub(r", \[plan_id=\d+\]", "", text)
        out.append("  " * depth + text[:140])
    return out


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from loomprep.plans import catalog
    from loomprep.session import build_session
    spark = build_session(8)
    for n in args or sorted(catalog.QUERIES):
        print(f"## {n}\n```")
        print("\n".join(summarize(catalog.QUERIES[n](spark, sf))))
        print("```\n")


if __name__ == "__main__":
    main()
