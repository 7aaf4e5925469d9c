import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from urbanlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="urbanlens-test-", dir="/tmp")
    session = get_session(
        master="local[4]",
        app_name="urbanlens-tests",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="urbanlens-case-", dir="/tmp")
