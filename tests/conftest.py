import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import drop_intermediates, local_session

    session = local_session(8, 4)
    yield session
    drop_intermediates(session)
    session.stop()
