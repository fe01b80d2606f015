import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from binlens.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=8, app_name="binlens-tests", driver_memory="6g")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="binlens-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def inputs(spark):
    from binlens.sources.fixtures import Inputs
    return Inputs(spark, SF_SMALL, cache_dir=tempfile.mkdtemp(prefix="binlens-test-inputs-"))
