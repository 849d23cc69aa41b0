import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tiermill.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(master="local[4]", shuffle_partitions=8, driver_memory="4g")
    yield session


@pytest.fixture()
def scratch(spark):
    from tiermill.session import new_scratch_path

    return new_scratch_path(spark, "test")
