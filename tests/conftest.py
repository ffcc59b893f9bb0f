import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eddy.session import build_session, checkpoint_dir
    s = build_session(master="local[*]", shuffle_partitions=8, app="eddy-tests",
                      extra={"spark.driver.memory": "8g"})
    checkpoint_dir(s)
    yield s
    s.stop()
