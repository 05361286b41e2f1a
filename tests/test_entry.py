"""The entry module without the optional parts of the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
SCRIPT = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "spikes_dips" in names and "pipeline" not in names, names
assert not any(name.startswith("op") for name in names)
assert set(entry.oracle_sql()) <= names
"""


def test_entry_without_the_training_data_package(tmp_path):
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(
        "llm", "corpus_pipeline.py", ".git", "__pycache__", "*.md"))
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_entry_without_a_module_that_only_optional_parts_need(tmp_path):
    """Their import fails somewhere inside; the other queries are there."""
    (tmp_path / "repo").mkdir()
    shutil.copytree(REPO, tmp_path / "repo", dirs_exist_ok=True,
                    ignore=shutil.ignore_patterns(".git", "__pycache__", "*.md"))
    block = "import sys\nfor name in ('tokenizers', 'public_tokenizers', 'ratingloom.llm'):\n    sys.modules[name] = None\n"
    done = subprocess.run([sys.executable, "-c", block + SCRIPT], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
