import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from paysight.session import get_spark
    s = get_spark("local[4]", app="paysight-tests", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paysight-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
