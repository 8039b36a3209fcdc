import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["snapflow/llm"], ["snapflow/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_the_training_data_subpackage(tmp_path, gone):
    """The entry imports and keeps its other queries where the subpackage, the pipeline or both are absent."""
    left_out = [ROOT / g for g in gone]
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if (ROOT / "corpus_pipeline.py") not in left_out and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    skip = lambda folder, names: [n for n in names if Path(folder) / n in left_out or n == "__pycache__"]
    shutil.copytree(ROOT / "snapflow", tmp_path / "snapflow", ignore=skip)
    said = subprocess.run(
        [sys.executable, "-B", "-c", "import __spark_entry__ as e; print(*e.queries()); e.oracle_sql()"],
        cwd=tmp_path, capture_output=True, text=True, timeout=120, check=False,
    )
    assert said.returncode == 0, said.stderr
    names = said.stdout.split()
    assert {"silver", "incremental_silver", "run_status"} <= set(names)
    assert "pipeline" not in names
    if "snapflow/llm" in gone:
        assert not any(n.startswith("op") and n[2].isdigit() for n in names)
