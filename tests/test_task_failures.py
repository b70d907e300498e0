"""Lake writes and signals stay exact while task attempts fail (child process, local[4,4])."""

import json
import os
import subprocess
import sys

PROBE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "failure_probe.py")


def test_results_exact_under_task_failures():
    out = subprocess.run([sys.executable, PROBE], capture_output=True, text=True, timeout=600, check=True)
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["failed_task_attempts"] > 0
    assert result["rows_written"] == result["rows_expected"]
    assert result["trades_exact"] and result["signals_exact"]
