"""All queries of this package with workers that cannot import it."""

import subprocess
import sys
from pathlib import Path

import pytest

from ratingloom.llm import queries

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from ratingloom.session import build_session
from __spark_entry__ import queries
spark = build_session("local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
                                      "spark.sql.warehouse.dir": "warehouse"}})
for name in {names!r}:
    print(name, len(queries()[name](spark, "/root/testdata/sf0.001").collect()), flush=True)
"""


@pytest.mark.parametrize("part", range(3))
def test_queries_run_from_elsewhere(tmp_path, part):
    """collect(), as count() would leave the functions out."""
    repo = str(Path(__file__).resolve().parent.parent.parent)
    names = sorted(queries.QUERIES)[part::3]
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, names=names)], cwd=tmp_path,
                          capture_output=True, text=True, timeout=600)
    found = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert set(found) == set(names) and all(int(n) > 0 for n in found.values()), done.stderr[-3000:]
