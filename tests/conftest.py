import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orebed.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orebed-test-"))
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
