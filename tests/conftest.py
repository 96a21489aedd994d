import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chartlift.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
