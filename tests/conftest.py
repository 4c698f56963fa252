import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from rillstream.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=8, shuffle=2)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(data_dir):
    import oracle

    return oracle.connect(data_dir)
