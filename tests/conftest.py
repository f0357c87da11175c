import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wattloom.session import clear_work, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_work(session)
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as plain tuples, sorted."""

    def collect(df, *names):
        return sorted(tuple(r) for r in (df.select(*names) if names else df).collect())

    return collect
