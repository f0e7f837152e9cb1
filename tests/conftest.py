import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local, ship

    session = local(__import__("os").environ.get("TEST_CPUS", "8"), 4, "4g")
    ship(session)
    yield session
    session.stop()
