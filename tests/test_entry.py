"""The driver's entry on a copy of the repository without the operators on texts."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from helixframe.catalog import QUERIES

REPO = Path(__file__).resolve().parent.parent


@pytest.fixture(params=["folders", "folders and pipeline"])
def bare_copy(request, tmp_path):
    """The repository without both folders of operators on texts, with and without their pipeline."""
    copy = tmp_path / "copy"
    skipped = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "llm")
    shutil.copytree(REPO, copy, ignore=skipped)
    if request.param != "folders":
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    return copy


def run(folder: Path, *args: str) -> str:
    done = subprocess.run(
        [sys.executable, *args], cwd=folder, capture_output=True, text=True, timeout=300, check=False
    )
    assert done.returncode == 0, done.stdout + done.stderr
    return done.stdout


def test_rest_works_without_texts(bare_copy):
    shown = run(
        bare_copy,
        "-c",
        "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))",
    )
    assert shown.split() == [str(len(QUERIES)), "True"]


def test_rest_of_the_tests_is_collected(bare_copy):
    collected = run(bare_copy, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider")
    assert "test_queries.py" in collected and "llm" not in collected
