"""Every registered query against its DuckDB twin on the smallest data set."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_all_queries_match_duckdb():
    r = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "check_oracle.py"), "/root/testdata/sf0.001"],
                       capture_output=True, text=True, timeout=1800)
    out = r.stdout
    assert "done, 0 problems" in out, out[-4000:]
