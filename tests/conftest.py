import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lumeval.session import get_session
    scratch = tempfile.mkdtemp(prefix="lumeval-tests-")
    s = get_session("local[*]", app_name="lumeval-tests", shuffle_partitions=8,
                    extra_conf={"spark.checkpoint.dir": scratch + "/ckpt",
                                "spark.sql.warehouse.dir": scratch + "/wh"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="lumeval-t-")
