"""bench.py prints exactly one JSON line with the keys the driver reads."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="row_count,store_totals_min_amount")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    doc = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= doc.keys()
    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and "errors" not in doc
    assert set(doc["queries"]) == {"row_count", "store_totals_min_amount"}
