import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("VELLUMARK_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from vellumark.session import build_session

    s = build_session(4, "tests")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
