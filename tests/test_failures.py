"""Task failures in write jobs: retried tasks give exact snapshots and metrics."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

from tests.conftest import ROOT


def test_failed_task_attempts_leave_exact_results():
    scratch = tempfile.mkdtemp(prefix="reelyard-failure-")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "failure_check.py"), scratch],
                         capture_output=True, text=True, timeout=600, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    r = json.loads(out.stdout.strip().splitlines()[-1])
    assert r["failures_injected"] == ["marker-merge", "marker-silver"]
    assert r["silver_same"] and r["silver_rows"] == r["silver_expected"]
    assert r["merge_rows"] == r["merge_read_back"] == r["merge_observed"] == r["merge_ids_unique"]
