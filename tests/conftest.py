import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from noticeworks.session import create_session

    session = create_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session
