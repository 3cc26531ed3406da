"""The entry must import wherever Spark's files lie, and from any folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

ELSEWHERE = """
import sys, pyspark
pyspark.__file__ = "/nowhere/pyspark/__init__.py"
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
assert len(entry.queries()) >= 95, len(entry.queries())
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_entry_imports_without_the_jars(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", ELSEWHERE, ROOT], cwd=tmp_path, capture_output=True, text=True,
        timeout=120,
    )
    assert done.returncode == 0, done.stderr
