"""The entry file on a copy of the repository without the text operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

TRIAL = f"""
import __spark_entry__ as entry
from tabwright.session import build_session
names = entry.queries()
assert "churn_frame" in names and not [n for n in names if n.startswith("op") or n == "pipeline"], sorted(names)
assert set(entry.oracle_sql()) <= set(names)
spark = build_session("without", "2")
print("ROWS", names["kfold_assignment"](spark, "{SF}").count())
spark.stop()
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")
@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_without_the_text_folders(tmp_path, keep_pipeline):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if keep_pipeline else ["corpus_pipeline.py"]))
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skip)
    env = {**os.environ, "PYTHONPATH": str(copy)}
    done = subprocess.run([sys.executable, "-c", TRIAL], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "ROWS 150" in done.stdout
