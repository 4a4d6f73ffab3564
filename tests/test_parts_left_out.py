"""The rest of the repository stands without the subpackage for training text."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
CODE = """
import __spark_entry__ as entry
from listenlytics.workloads import QUERIES
from listenlytics.oracle import ORACLE_SQL
assert entry.queries().keys() == QUERIES.keys(), entry.queries().keys()
assert entry.oracle_sql().keys() == ORACLE_SQL.keys()
assert len(QUERIES) >= 49
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_subpackage(tmp_path, pipeline):
    copy = tmp_path / "repo"
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__")
    shutil.copytree(REPO, copy, ignore=left_out)
    (copy / "listenlytics/llm/__pycache__").mkdir(parents=True)  # what a deletion may leave
    if not pipeline:
        copy.joinpath("corpus_pipeline.py").unlink(missing_ok=True)
    subprocess.run([sys.executable, "-c", CODE], cwd=copy, check=True, env={"PYTHONPATH": "", "PATH": ""})


def test_nothing_else_imports_the_subpackage():
    others = [p for p in (REPO / "listenlytics").rglob("*.py") if "llm" not in p.relative_to(REPO).parts]
    assert others and not [p for p in others if "llm" in p.read_text()]
