import json
import os
import subprocess
import sys


def test_results_survive_task_retries():
    probe = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_probe.py")
    out = subprocess.run([sys.executable, probe], capture_output=True, text=True, timeout=600)
    line = [l for l in out.stdout.splitlines() if l.startswith("{")]
    assert line, out.stderr[-2000:]
    res = json.loads(line[-1])
    assert res == {"grads_equal": True, "row_index_equal": True, "rows": 500}
