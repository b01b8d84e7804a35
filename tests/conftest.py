import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from varloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def checkpoint_dir(tmp_path_factory):
    return tmp_path_factory.mktemp("checkpoint")


@pytest.fixture(scope="session")
def spark(checkpoint_dir):
    session = build_session(
        "tests", "local[8]", spark__checkpoint__dir=str(checkpoint_dir), spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    return session
