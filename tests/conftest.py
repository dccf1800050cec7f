import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfwise.session import local_session

    folders = {name: str(tmp_path_factory.mktemp(name)) for name in ("warehouse", "checkpoint")}
    session = local_session(8, "shelfwise-tests", spark__sql__warehouse__dir=folders["warehouse"], spark__checkpoint__dir=folders["checkpoint"])
    yield session
    session.stop()
