import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from martkit.session import local_session

    session = local_session(8, 8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
