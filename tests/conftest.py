import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from loadbay.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[8]", {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def settings(spark):
    """Set SQL options for one test."""
    old = {}

    def put(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            old.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
