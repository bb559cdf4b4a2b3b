"""The entry module lists its queries without a Spark session."""

import subprocess
import sys

from conftest import ROOT


def test_queries_are_listed_without_a_session():
    code = "import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); assert set(o) <= set(q) and len(q) > 200"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
