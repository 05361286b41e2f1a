"""Python workers that cannot import the package."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from ratingloom.session import build_session
from __spark_entry__ import queries
spark = build_session("local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
from ratingloom.operators import text_vectors
text_vectors.is_small = lambda _: False
for name in ("similar_topk", "similar_topk_index_tiles", "text_vectors"):
    print(name, len(queries()[name](spark, "/root/testdata/sf0.001").collect()))
"""


def test_tile_search_runs_from_elsewhere(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path,
                          capture_output=True, text=True, timeout=300)
    for line in ("similar_topk 500", "similar_topk_index_tiles 500", "text_vectors 20000"):
        assert line in done.stdout, done.stderr[-2000:]
