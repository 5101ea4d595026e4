"""The entry point without the optional training-data package."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.modules["{name}"] = None
import __spark_entry__ as entry
from netaudit.registry.files import FILE_QUERIES
from netaudit.registry.queries import QUERIES
from netaudit.registry.runs import RUN_QUERIES
assert entry.queries() == QUERIES | FILE_QUERIES | RUN_QUERIES and set(entry.oracle_sql()) == set(entry.queries())
"""


def test_queries_without_the_package():
    for name in ("netaudit.llm", "corpus_pipeline"):
        subprocess.run([sys.executable, "-c", SCRIPT.format(name=name)], check=True, cwd=Path(__file__).parent.parent)


def test_other_missing_modules_are_not_hidden():
    found = subprocess.run([sys.executable, "-c", SCRIPT.format(name="pyspark")], cwd=Path(__file__).parent.parent, capture_output=True)
    assert found.returncode != 0
