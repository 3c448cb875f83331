import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from store_rows import SMALL

from mercato.lakehouse import Lakehouse
from mercato.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path / "lake")).create()


@pytest.fixture
def sf_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("benchmark tables not present")
    return SMALL
