import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()
