import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fleetloom.session import drop_scratch, local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="fleetloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture
def small_limits(monkeypatch):
    """Limits so low that the ways for large keys and tables are taken."""
    from fleetloom.operators import lookups, pairing, position

    monkeypatch.setattr(position, "ROWS_PER_TASK", 40)
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(pairing, "ROWS_PER_COPY", 1)


def values(df, *columns):
    """The rows as sorted tuples."""
    names = columns or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
