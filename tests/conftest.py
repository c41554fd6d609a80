from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from citeweave.session import get_session

    session = get_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no driver tables here")
    return path
