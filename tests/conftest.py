import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import build_session, clear_scratch
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def work(spark):
    """A function giving new paths in the shared folder."""
    from tidemill.session import scratch
    return lambda label="t": scratch(spark, label)
