"""The entry without the optional part, in each way it can be missing."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tillgrain.plans import catalog

TOP = Path(__file__).resolve().parents[1]
RETAIL = len(catalog.queries())
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q))"


def counted(folder: Path, before: str = "") -> tuple[int, str]:
    done = subprocess.run(
        [sys.executable, "-c", before + COUNT], cwd=folder, capture_output=True, text=True, check=True
    )
    number, covered = done.stdout.split()
    return int(number), covered


@pytest.fixture
def copy(tmp_path):
    for name in ("tillgrain", "__spark_entry__.py", "duckdb_oracle.py", "corpus_pipeline.py"):
        source = TOP / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif source.exists():
            shutil.copy(source, tmp_path / name)
    return tmp_path


def test_without_the_folder(copy):
    assert counted(copy) == (RETAIL, "True")


def test_with_an_empty_folder(copy):
    (copy / "tillgrain" / "llm").mkdir()
    assert counted(copy) == (RETAIL, "True")


def test_without_the_pipeline_file(copy):
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert counted(copy) == (RETAIL, "True")


def test_without_the_vocabularies():
    hidden = "import sys; sys.modules['public_tokenizers'] = None; "
    assert counted(TOP, hidden) == (RETAIL, "True")
