"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf_dir):
    env = dict(os.environ, BENCH_SF_DIR=sf_dir, BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="q018,q094")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["n_queries"] == 2 and set(d["queries"]) == {
        "q018_negative_ledger_accounts", "q094_high_risk_accounts"}
    assert d["value"] > 0 and d["sf"] == os.path.basename(sf_dir).removeprefix("sf")
