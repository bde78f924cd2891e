import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wayline.session import local_session, with_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = with_package(local_session(4, **{"spark.sql.shuffle.partitions": "4"}))
    yield session
    session.stop()
