import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rideflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="rideflow-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None) and session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rideflow-tests-"))
    yield session
    session.stop()
