"""Jobs give the same results when task attempts fail and are retried."""

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_results_survive_failed_task_attempts():
    proc = subprocess.run(
        [sys.executable, os.path.join(HERE, "resilience", "flaky_run.py"), "/root/testdata/sf0.001"],
        capture_output=True, text=True, timeout=600,
    )
    lines = [line for line in proc.stdout.splitlines() if line.startswith("{")]
    assert proc.returncode == 0 and lines, proc.stderr[-3000:]
    result = json.loads(lines[-1])
    assert result["injected_failures"] > 0, result
    assert len(result["same"]) == 7 and all(result["same"].values()), result
