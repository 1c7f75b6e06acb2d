import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ladle.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", spark__sql__shuffle__partitions="2", spark__driver__memory="4g",
                spark__sql__streaming__noDataMicroBatches__enabled="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
    return collect
