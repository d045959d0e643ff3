import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from deckmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("deckmill-tests", "local[8]", 4, spark__ui__enabled="false", spark__driver__memory="6g",
                            spark__sql__streaming__stopTimeout="30s")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
