from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyfolio.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4, spark__ui__enabled="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def day():
    """Sessions of a test: day(1) is Tuesday 2024-01-02."""
    return lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows(df, *order):
    """Rows as tuples in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr) if not order else [
        tuple(r) for r in df.orderBy(*order).collect()
    ]
