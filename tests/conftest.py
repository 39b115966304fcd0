import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from starkiln.session import local_session

    wh = tempfile.mkdtemp(prefix="starkiln-test-wh-")
    s = local_session("*", shuffle_partitions=8, app="starkiln-tests", warehouse_dir=wh)
    yield s
    s.stop()


@pytest.fixture()
def root(spark):
    """A fresh table root per test, below the session's checkpoint folder."""
    from starkiln.session import scratch_path
    import uuid

    return scratch_path(spark, "test-tables", uuid.uuid4().hex)


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
