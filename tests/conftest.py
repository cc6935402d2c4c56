import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starsift.session import SMALL_TABLES, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ["PYTHONPATH"] = sys.path[0]  # for the Python workers
    session = build_session(
        "starsift-tests",
        "local[4]",
        4,
        {
            **SMALL_TABLES,
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
