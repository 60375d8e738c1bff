import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from helpers import SMALL  # noqa: E402
from kontor.session import local_session  # noqa: E402
from kontor.sources.retail import RetailSource, RetailStar  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 8, "6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def src(spark):
    return RetailSource(spark, SMALL)


@pytest.fixture(scope="session")
def star(spark):
    return RetailStar(spark, SMALL)


@pytest.fixture
def frame(spark):
    """A frame from rows and a DDL text."""
    return lambda rows, layout: spark.createDataFrame(rows, layout)
