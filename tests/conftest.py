import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tabwright.session import build_session

    shared = str(tmp_path_factory.mktemp("shared"))
    s = build_session("tests", "4", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
