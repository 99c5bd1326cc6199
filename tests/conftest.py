import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyboard.sources.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame, as a sorted list of tuples."""

    def collect(df, *columns):
        out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect
