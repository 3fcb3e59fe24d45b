"""The entry module with and without the training-data folders."""

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_training_data_folders(tmp_path, pipeline):
    shutil.copytree(os.path.join(ROOT, "sluice"), tmp_path / "sluice", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    made, sql = json.loads(out.stdout.splitlines()[-1])
    assert "merge_orders" in made and set(sql) == set(made)
    assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in made)
