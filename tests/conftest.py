import os

import pytest

from terrella.session import session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("local[4]", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="4g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")), spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF
