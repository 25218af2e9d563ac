import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tempora.session import get_session

    # Tests set their own checkpoint folder; on a cluster the setting is given.
    ckpt = tempfile.mkdtemp(prefix="tempora-test-ckpt-")
    s = get_session("local[4]", app_name="tempora-tests", shuffle_partitions=8,
                    extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tempora-test-")
