import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from casegrid.session import get_spark

    s = get_spark("casegrid-tests", master="local[*]", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="casegrid-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def dims(spark):
    from casegrid.dims import surveillance_dims

    return surveillance_dims(spark)


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="casegrid-test-")
