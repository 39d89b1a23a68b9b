"""The entry point without its optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_folders(tmp_path, pipeline):
    """Only the folders go, or the pipeline's file with them; old byte code may be left behind."""
    copy = str(tmp_path / "repo")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])))
    os.makedirs(os.path.join(copy, "basketloom", "llm", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["155", "0", "True"], out.stderr[-2000:]
