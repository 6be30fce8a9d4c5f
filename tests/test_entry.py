"""The driver contract holds without the optional subpackage and its packages."""

import subprocess
import sys
from pathlib import Path

from saltmarsh.plans import ORACLE, QUERIES

CODE = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None  # an import of it fails
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


def entry_counts(*blocked):
    root = str(Path(__file__).resolve().parents[1])
    out = subprocess.run([sys.executable, "-c", CODE.format(blocked=blocked)], cwd=root, capture_output=True, text=True, check=True)
    return tuple(int(x) for x in out.stdout.split()[-2:])


def test_queries_without_optional_parts():
    core = (len(QUERIES), len(ORACLE))
    for blocked in (("zstandard",), ("saltmarsh.llm",), ("corpus_pipeline",)):
        assert entry_counts(*blocked) == core
