import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickloom import session

    built = session.build(
        "local[8]",
        "tickloom-tests",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
