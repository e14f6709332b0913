from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    from voxloom.session import local_session, ship

    s = local_session(4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    ship(s)
    yield s
    s.stop()
