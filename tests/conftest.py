import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revlens.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    stage = tempfile.mkdtemp(prefix="revlens-test-")
    session = get_session(
        "local[4]",
        app_name="revlens-tests",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": stage, "spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
