"""The driver's contract where the training-data folders are gone."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("without_pipeline", [True, False])
def test_entry_without_the_training_data_folders(tmp_path, without_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "isobar", copy / "isobar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if not (without_pipeline and name == "corpus_pipeline.py"):
            shutil.copy(ROOT / name, copy / name) if (ROOT / name).exists() else None
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)


@pytest.mark.parametrize("hidden", ["zstandard", "public_tokenizers"])
def test_entry_where_a_library_is_missing_or_a_folder_is_empty(tmp_path, hidden):
    """What the training-data part needs may not be there; the feeds' queries are."""
    shutil.copytree(ROOT / "isobar", tmp_path / "isobar", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path / name) if (ROOT / name).exists() else None
    code = f"import sys; sys.modules['{hidden}'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(n.startswith('op') for n in q) and 'pipeline' not in q"
    if (ROOT / "isobar" / "llm").exists():
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
        shutil.rmtree(tmp_path / "isobar" / "llm")
    (tmp_path / "isobar" / "llm").mkdir(exist_ok=True)
    subprocess.run([sys.executable, "-c", code.replace(f"sys.modules['{hidden}'] = None; ", "")], cwd=tmp_path, check=True, timeout=120)
