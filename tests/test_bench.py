"""bench.py keeps its contract: one JSON line with the documented keys."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SMOKE


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMOKE, BENCH_REPEAT="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "row_count", "upsert"],
                         capture_output=True, text=True, timeout=600, cwd=ROOT, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    r = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(r)
    assert r["unit"] == "sec" and set(r["queries"]) == {"row_count", "upsert"}
    assert abs(r["value"] - sum(r["queries"].values())) < 1e-6
