import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cardmill.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# One session runs all tests: it keeps the descriptions of few plans, jobs and stages.
KEPT = {"spark.sql.ui.retainedExecutions": "200", "spark.ui.retainedJobs": "200", "spark.ui.retainedStages": "200", "spark.ui.retainedTasks": "5000"}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cardmill-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", **KEPT},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
