import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lagframe.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="lagframe-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a list of tuples ordered by the given (or all) columns."""
    cols = cols or tuple(df.columns)
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]
