import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from vitrine.session import get_session

    s = get_session(master="local[*]", app="vitrine-tests", shuffle_partitions=8, checkpoint=str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()
