from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from harrowmill.session import build_session

    session = build_session("tests", cpus="4", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()
