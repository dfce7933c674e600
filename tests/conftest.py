import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from courtflow.session import local_session

    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
