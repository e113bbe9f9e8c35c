"""The entry in copies of the repository without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

PARTS = ["tidecall", "tests", "__spark_entry__.py", "corpus_pipeline.py"]
ASK = """
import __spark_entry__ as e
from tidecall.plans.catalogue import ORACLES, QUERIES
assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
print(sorted(set(e.queries()) - set(QUERIES)))
"""


@pytest.mark.parametrize("without", [[], ["corpus_pipeline.py"]])
def test_without_the_subpackage(tmp_path, without):
    """With its two folders gone, with and without the pipeline, the entry and the other tests still load."""
    leave = shutil.ignore_patterns("llm", "__pycache__")
    for part in PARTS:
        source = os.path.join(ROOT, part)
        if part in without or not os.path.exists(source):
            continue
        (shutil.copytree if os.path.isdir(source) else shutil.copy)(source, tmp_path / part, **({"ignore": leave} if os.path.isdir(source) else {}))
    run = lambda *a: subprocess.run([sys.executable, *a], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    asked = run("-c", ASK)
    assert asked.returncode == 0, asked.stderr
    assert asked.stdout.strip() == "[]"
    collected = run("-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert collected.returncode == 0, collected.stdout[-2000:]
