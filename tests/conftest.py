import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        # Tiny frames: compiling stages would take longer than running them.
        "spark.sql.codegen.wholeStage": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted rows of a frame, as plain tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [str(v) for v in r])
    return collect
