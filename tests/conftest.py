import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]


@pytest.fixture(scope="session")
def spark():
    from shoptally.plans.session import local_session

    session = local_session("tests", cpus=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def retail(spark):
    """The eight tables with a handful of rows each, every key resolving."""
    from frames import small_retail

    return small_retail(spark)
