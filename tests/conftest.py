import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))



@pytest.fixture(scope="session")
def spark():
    from trainprep.session import get_spark

    s = get_spark("*", app="trainprep-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_folder(spark):
    from trainprep.session import scratch_dir

    return scratch_dir(spark, "test")
