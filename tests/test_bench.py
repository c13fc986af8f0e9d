"""bench.py prints one JSON line with the driver's fields."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4")
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "block_use_pivot"],
        capture_output=True, text=True, env=env, timeout=600, check=True,
    )
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["metric"] and out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"block_use_pivot"} and out["value"] > 0
