"""The entry point without the optional training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def count(tmp_path, *gone):
    """How many queries and SQL equivalents a copy of the tree without ``gone`` registers."""
    skip = [str(ROOT / g) for g in gone] + [str(ROOT / ".git")]
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda folder, names: [n for n in names if f"{folder}/{n}" in skip or n == "__pycache__"])
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(q) == set(e.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in q))"
    return subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True).stdout.split()


def test_without_both_folders(tmp_path):
    assert count(tmp_path, "tallyboard/llm", "tests/llm") == ["39", "True", "False"]


def test_without_the_pipeline_as_well(tmp_path):
    assert count(tmp_path, "tallyboard/llm", "tests/llm", "corpus_pipeline.py") == ["39", "True", "False"]
