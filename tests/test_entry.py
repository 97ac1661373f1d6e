"""The driver contract holds without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from aerolake.plans.registry import ORACLES, QUERIES

REPO = os.path.dirname(os.path.abspath(entry.__file__))
SAY = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries())); print('TWINS', *sorted(e.oracle_sql()))"


def names(folder, env=None):
    run = subprocess.run([sys.executable, "-B", "-c", SAY], cwd=folder, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": "", **(env or {})}, check=True)
    said = dict(line.split(" ", 1) for line in run.stdout.splitlines())
    return said["NAMES"].split(), said["TWINS"].split()


def copied(folder, left_out):
    shutil.copytree(REPO, f"{folder}/copy", ignore=lambda top, found: [
        x for x in found if x in (".git", "__pycache__") or os.path.relpath(os.path.join(top, x), REPO) in left_out])
    return f"{folder}/copy"


@pytest.mark.parametrize("left_out", [
    ("aerolake/llm", "tests/llm"),
    ("aerolake/llm", "tests/llm", "corpus_pipeline.py"),
])
def test_without_the_subpackage(folder, left_out):
    found, twins = names(copied(folder, left_out))
    assert found == sorted(QUERIES)
    assert twins == sorted(ORACLES)


def test_without_the_pipeline(folder):
    if not os.path.isdir(f"{REPO}/aerolake/llm"):
        pytest.skip("no subpackage")
    found, _ = names(copied(folder, ("corpus_pipeline.py",)))
    assert set(QUERIES) < set(found) and "pipeline" not in found


def test_without_a_library_of_the_subpackage(folder):
    copy = copied(folder, ())
    with open(f"{copy}/xxhash.py", "w") as f:
        f.write("raise ImportError('not installed')\n")
    found, _ = names(copy)
    assert found == sorted(QUERIES)
