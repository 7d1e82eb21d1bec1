"""bench.py keeps its contract: one JSON line on stdout with the agreed keys."""

import json
import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_QUERIES="parse_entries,alerts_correlated")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {"parse_entries", "alerts_correlated"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3) or abs(rec["value"] - sum(rec["queries"].values())) < 0.01
