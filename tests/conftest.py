from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=4, shuffle_partitions=4, **{"spark.driver.memory": "4g", "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df, *columns: sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
