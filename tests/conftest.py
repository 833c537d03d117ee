import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from martlane.session import get_spark
    s = get_spark("local[4]", app="martlane-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="martlane-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
