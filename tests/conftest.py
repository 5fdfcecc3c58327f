from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripwire.schema import TRANSACTION  # noqa: E402
from tripwire.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="tripwire-tests")
    yield s


def ts(text: str) -> datetime:
    """``HH:MM:SS[.ffffff]`` on 2024-01-01, or a full ISO string."""
    if "T" in text or "-" in text:
        return datetime.fromisoformat(text)
    return datetime.fromisoformat(f"2024-01-01T{text}")


@pytest.fixture
def make_tx(spark):
    def build(rows):
        data = [(u, ts(t) if isinstance(t, str) else t, c, a, loc) for (u, t, c, a, loc) in rows]
        return spark.createDataFrame(data, TRANSACTION)
    return build


def rows_of(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
