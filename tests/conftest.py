import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketpulse.session import get_session
    ck = tempfile.mkdtemp(prefix="mp-test-ckpt-")
    s = get_session("local[4]", app_name="marketpulse-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ck,
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="mp-test-wh-"),
                           "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
