"""The entry without the folders that can be deleted."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_entry_imports_without_the_training_data_folders(tmp_path, keep_pipeline):
    skipped = shutil.ignore_patterns("llm", "__pycache__", *([] if keep_pipeline else ["corpus_pipeline.py"]))
    for name in ("tracewell", "verification", "__spark_entry__.py", "corpus_pipeline.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=skipped)
        elif source.exists() and (keep_pipeline or name != "corpus_pipeline.py"):
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in q), set(e.oracle_sql()) <= set(q))"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    count, dealt, known = done.stdout.split()[-3:]
    assert int(count) >= 169 and dealt == "0" and known == "True"
