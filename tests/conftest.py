import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from barflow.session import build_session

    s = build_session(master="local[8]", app="barflow-tests", spark__sql__shuffle__partitions="8")
    yield s
    from barflow.session import remove_scratch

    remove_scratch(s)
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
