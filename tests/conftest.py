import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierloom.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tierloom-tests-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
