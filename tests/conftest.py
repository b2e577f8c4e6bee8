from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from geomart.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4, app="geomart-tests")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
