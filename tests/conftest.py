import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakewarden.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", name="tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def plan_of(df) -> str:
    """Physical plan text."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
