import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from orbgrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "orbgrid-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
