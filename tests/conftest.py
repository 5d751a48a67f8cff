import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from shelfline.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
