import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tilewright.session import local_session
    from tilewright.staging import release

    session = local_session("8", memory="6g")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_DIR
