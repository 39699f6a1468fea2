import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from vigil.session import build_session

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def vitals(spark):
    """The tiny patient table, kept in memory for the whole run."""
    from vigil.plans import inputs

    return inputs.vitals(spark, TINY).cache()
