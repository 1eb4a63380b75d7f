import os
import subprocess
import sys


def test_writes_and_reads_survive_failed_task_attempts(tmp):
    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_job.py")
    out = subprocess.run([sys.executable, job, tmp], capture_output=True, text=True, timeout=600)
    assert "RESULT ok" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
    assert "injected loss of the first attempt" in out.stderr  # the failures did happen
    assert "injected loss of a writer attempt" in out.stderr
    assert "injected loss of a stream read attempt" in out.stderr
