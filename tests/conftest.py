import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from textmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Small data: few shuffle partitions, and no call sites recorded for every column expression.
    session = local_session(
        8,
        "textmill-tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="textmill-tests-"), "spark.python.sql.dataFrameDebugging.enabled": "false"},
    )
    yield session
    session.stop()
