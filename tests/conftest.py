import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"
ORACLE_SF = os.environ.get("MARTFORGE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from martforge.session import build_session

    ckpt = tempfile.mkdtemp(prefix="martforge-test-ckpt-")
    s = build_session("local[4]", app_name="martforge-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from martforge.session import work_dir

    return work_dir(spark, "test")
