"""bench.py prints one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_QUERIES="counts_long,dedup_counted")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=600,
        cwd="/tmp",
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and d["sf"] == 0.001
    assert set(d["queries"]) == {"counts_long", "dedup_counted"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
