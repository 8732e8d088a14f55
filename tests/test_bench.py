"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_contract():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2")
    p = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "normalize_text", "bottomk_sample"],
                       capture_output=True, text=True, env=env, timeout=600)
    assert p.returncode == 0, p.stderr[-2000:]
    lines = [ln for ln in p.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= out.keys()
    assert out["unit"] == "sec" and set(out["queries"]) == {"normalize_text", "bottomk_sample"}
    assert out["value"] > 0 and out["sf"] == 0.001
