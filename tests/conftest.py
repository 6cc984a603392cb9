import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(partitions="4")


@pytest.fixture
def frame(spark):
    """Make a frame from literal rows."""
    from tidespan import TemporalFrame

    def make(rows, schema, keys=(), **props):
        out = TemporalFrame(spark.createDataFrame(rows, schema), keys)
        return out.declare(**props) if props else out

    return make


def rows(out, *columns):
    df = out.df if hasattr(out, "df") else out
    return sorted(tuple(r) for r in df.select(*columns).collect())
