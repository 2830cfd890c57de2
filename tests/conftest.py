import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from matchwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app_name="matchwright-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples (None sorts first)."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in df.collect()),
            key=lambda t: [(v is not None, str(v)) for v in t],
        )

    return collect
