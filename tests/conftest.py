import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskweave.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture
def at():
    """Moment some seconds after the start."""
    return lambda seconds: START + timedelta(seconds=seconds)
