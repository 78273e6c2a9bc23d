import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from newsdesk.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), sorted."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
