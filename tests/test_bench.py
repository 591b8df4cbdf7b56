"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from fixtures import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert rec["value"] == round(sum(rec["queries"].values()), 3)
    assert {"feature_table", "fit_random_forest"} <= set(rec["queries"])
