"""bench.py prints exactly one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="region_report,roc_auc,asof_join")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=900, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d) and d["unit"] == "sec"
    assert set(d["queries"]) == {"region_report", "roc_auc", "asof_join"} and d["sf"] == 0.001
