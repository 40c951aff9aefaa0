import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from feedloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        out = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in out.collect()), key=repr)
    return collect
