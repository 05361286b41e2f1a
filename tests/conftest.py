import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ratingloom.session import build_session
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("local[8]", **{
        "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": f"file://{shared}/warehouse",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
