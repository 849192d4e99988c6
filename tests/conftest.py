import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import checkpoint_dir, get_session

    s = get_session(master="local[4]", shuffle_partitions=8, app="tessera-tests")
    checkpoint_dir(s)
    yield s

