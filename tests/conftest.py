import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pricelake.session import CHECKPOINT_DIR, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="pricelake-tests-")
    session = local_session(
        "tests",
        "8",
        **{CHECKPOINT_DIR: f"{work}/shared", "spark.sql.warehouse.dir": f"{work}/warehouse"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df):
    """All rows as plain tuples, in a stable order."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [str(v) for v in row])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
