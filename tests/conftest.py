import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapeweave.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    spark = session("tests", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
