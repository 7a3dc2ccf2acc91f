import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wingspan.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="wingspan-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    """Collected rows as plain tuples (selected columns, in order)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
