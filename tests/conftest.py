import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import local_session

    session = local_session(8, "tidemill-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
