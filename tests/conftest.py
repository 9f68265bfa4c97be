from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siltgate.plans.sizing import Limits  # noqa: E402
from siltgate.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture
def large():
    """Limits under which every input counts as large: nothing is broadcast, keys of 3 rows are hot."""
    return Limits(broadcast_bytes=-1, small_bytes=-1, hot_rows=3, sample=1.0)
