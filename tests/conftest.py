import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {"sf0.001": "/root/testdata/sf0.001", "sf0.01": "/root/testdata/sf0.01"}


@pytest.fixture(scope="session")
def spark():
    from tablestream.session import local_session

    ckpt = tempfile.mkdtemp(prefix="ts-test-ckpt-")
    s = local_session("*", shuffle_partitions=8, app="tablestream-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tablestream.session import checkpoint_dir
    d = tempfile.mkdtemp(prefix="case-", dir=checkpoint_dir(spark))
    return d
