from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="4", app="tests")


@pytest.fixture(scope="session")
def rows(spark):
    """Build an all-string table with row_index from column lists."""

    def build(**columns):
        names = list(columns)
        data = [(i, *values) for i, values in enumerate(zip(*columns.values()))]
        return spark.createDataFrame(data, "row_index long, " + ", ".join(f"{n} string" for n in names))

    return build
