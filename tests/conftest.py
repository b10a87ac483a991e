import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brightledger.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-wh-", dir="/tmp"),
    }
    s = build_session("tests", "local[8]", **conf)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture(scope="session")
def tables(spark, folder):
    from brightledger.sources.tables import Tables

    return Tables(spark, folder)
