import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [*sys.path[:2], os.environ.get("PYTHONPATH")]))

from passtrail.session import build_session  # noqa: E402


# Columns need a running session, also those that test modules build while they are collected.
SESSION = build_session(
    "tests",
    "local[4]",
    **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
       "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-")},
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION
