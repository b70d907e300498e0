"""Task balance under a hot key, measured from Spark's event log in a child process."""

import json
import os
import subprocess
import sys

PROBE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "skew_probe.py")


def test_salted_join_back_bounds_the_largest_task():
    out = subprocess.run(
        [sys.executable, PROBE, "300000", "0.3333", "10000"], capture_output=True, text=True, timeout=600, check=True
    )
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["hot_rows"] == 100_000
    # the window form sends the whole hot key to one task ...
    assert result["max_task_records_window"] >= result["hot_rows"]
    # ... the salted join-back spreads it over ceil(100000 / 10000) = 10 salts
    assert result["max_task_records_salted"] < 0.4 * result["hot_rows"]
