from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path


def test_lost_tasks_change_neither_rows_nor_counts(folder):
    """A session of its own: the other tests run without a second attempt."""
    script = Path(__file__).with_name("retry_job.py")
    environment = {**os.environ, "PYTHONPATH": str(script.parents[1])}
    done = subprocess.run(
        [sys.executable, str(script), folder], env=environment, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    calm, disturbed = json.loads(done.stdout.splitlines()[-1])
    assert calm == disturbed
    assert calm[0] == calm[2] > 0 and calm[1] == 0 and calm[3] > 0
