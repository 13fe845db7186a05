"""The driver contract, also of a copy that lacks the training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROBE = (
    "import __spark_entry__ as e; from bulletin.plans.catalog import QUERIES; from bulletin.plans.oracles import ORACLES;"
    "assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql());"
    "assert set(e.oracle_sql()) <= set(e.queries());"
    "print(len(set(e.queries()) - set(QUERIES)))"
)


def extra_queries(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return int(subprocess.run([sys.executable, "-c", PROBE], cwd=folder, env=env, capture_output=True, text=True, check=True).stdout)


@pytest.mark.parametrize("gone", [("bulletin/llm",), ("bulletin/llm", "corpus_pipeline.py")])
def test_the_rest_imports_without_the_operator_package(tmp_path, gone):
    left_out = {ROOT / g for g in gone} | {ROOT / "tests", ROOT / ".git"}
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if Path(folder) / n in left_out or n == "__pycache__"])
    assert extra_queries(copy) == 0


def test_everything_that_is_here_is_registered():
    named = (ROOT / "bulletin/llm/queries.py").exists()
    assert (extra_queries(ROOT) > 0) == named
