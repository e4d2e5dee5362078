import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from netgroom.session import local_session, tune

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return tune(local_session("tests", 8, spark__sql__shuffle__partitions="4"))
