"""Retried tasks do not change results (deterministic plans, pinned blocks)."""

from __future__ import annotations

import json
import os
import subprocess
import sys


def test_results_survive_task_retries():
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "fault_job.py")], capture_output=True, text=True,
                         timeout=600)
    line = [l for l in out.stdout.splitlines() if l.startswith("{")]
    assert line, out.stderr[-2000:]
    r = json.loads(line[-1])
    assert r["ranks_ok"]
    assert r["ap"] == r["clean_ap"]
