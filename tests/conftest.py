import os
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

from tsline.session import get_session, scratch_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="tsline-tests-")
    session = get_session("local[4]", app="tsline-tests", shuffle_partitions=4,
                          conf={"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir(spark):
    """A fresh folder per test under the session's shared checkpoint folder."""
    return scratch_path(spark, "test")


def lines_of(df, col="line"):
    return [r[col] for r in df.collect()]
