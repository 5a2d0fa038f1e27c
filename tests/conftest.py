import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from screenline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def rows(spark):
    from screenline.session import local_table

    return lambda data, schema: local_table(spark, data, schema)
