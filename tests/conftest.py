import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shoal.session import build_session, checkpoint_dir
    s = build_session(master="local[4]", app="shoal-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s
    s.stop()
