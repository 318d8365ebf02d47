import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, "4g", str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, in column order given or own order."""

    def read(df, *columns):
        names = columns or df.columns
        return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)

    return read
