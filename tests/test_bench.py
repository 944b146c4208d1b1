"""bench.py prints one JSON line in the driver's format (run in its own JVM)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "report_status", "top_k"],
                         env=env, capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    record = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(record)
    assert record["unit"] == "sec" and record["sf"] == "0.001"
    assert set(record["queries"]) == {"report_status", "top_k"}
    assert record["value"] == round(sum(record["queries"].values()), 3) or abs(
        record["value"] - sum(record["queries"].values())) < 0.01
