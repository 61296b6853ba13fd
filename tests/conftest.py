import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tramline.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("8", 4)
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("stages")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def root():
    return "/root/testdata/sf0.001"
