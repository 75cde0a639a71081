import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "3g", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def plain_rows():
    """Rows as plain Python values, nested rows as dictionaries."""

    def convert(value):
        if hasattr(value, "asDict"):
            return {k: convert(v) for k, v in value.asDict().items()}
        if isinstance(value, list):
            return [convert(v) for v in value]
        return value

    return lambda df: [convert(r) for r in df.collect()]
