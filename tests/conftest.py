import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lakelayers.session import get_spark  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not TESTDATA.exists():
        pytest.skip("test tables are not there")
    return str(TESTDATA)
