import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from heliopanel.session import get_spark
    s = get_spark("local[4]", "heliopanel-tests", shuffle_partitions=8,
                  extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getConf().get("spark.checkpoint.dir", None)):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hp-test-ckpt-"))
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="hp-test-")
