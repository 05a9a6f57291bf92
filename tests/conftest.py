import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYTHONPATH", ROOT)
    from threadlens import build_session
    return build_session("tests", master="local[8]", shuffle_partitions=4, spark__ui__enabled="false",
                         spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
