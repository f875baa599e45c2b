import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millrace.core.session import session

    s = session(
        "local[4]", "tests", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__local__dir=tempfile.mkdtemp(prefix="spark-", dir="/tmp"), spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables here")
    return SMALL
