"""The entry module of a copy of the repository without the training-data part."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
ASK = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_core_queries_are_left(tmp_path, pipeline):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "spark-warehouse"))
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    run = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)})
    assert run.returncode == 0, run.stderr
    names, oracles = json.loads(run.stdout)
    assert "release_status" in names and len(names) > 50 and set(oracles) <= set(names)
    assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names)
