import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fieldglass import session  # noqa: E402

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = session.build(
        "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(shared), "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(shared / "warehouse")}
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def middle():
    return MIDDLE
