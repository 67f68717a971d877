import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from partflow.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # unset checkpoint dir -> fresh temp folder; catalog tables of the layout test go to a temp warehouse
    s = get_session("local[4]", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="partflow-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


class DictSource:
    """Entity source backed by in-memory DataFrames (tests only)."""

    def __init__(self, frames):
        self.frames = frames

    def entity(self, name):
        return self.frames[name]


@pytest.fixture
def dict_source():
    return DictSource
