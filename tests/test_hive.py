import os
import subprocess
import sys
import tempfile


def test_hive_rcfile_and_partition_overwrite():
    work = tempfile.mkdtemp(prefix="sluice-hive-", dir="/tmp")
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "hive_check.py")
    r = subprocess.run([sys.executable, script, os.path.join(work, "warehouse")], cwd=work,
                       capture_output=True, text=True, timeout=600)
    assert "HIVE_CHECK_OK" in r.stdout, (r.stdout[-2000:], r.stderr[-4000:])
