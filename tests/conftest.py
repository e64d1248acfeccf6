import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from stintflow.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="8", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in picked.collect()), key=repr)
