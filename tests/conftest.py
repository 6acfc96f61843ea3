import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

T0 = 1704067200  # a multiple of 30


@pytest.fixture(scope="session")
def spark():
    from loadcast.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app="loadcast-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """FIXTURES.md §4: four readings of house 0."""
    from loadcast.sources import SENSOR
    rows = [(1, T0, 10.0, 1, 0, 0, 0), (2, T0, 20.0, 1, 1, 0, 0),
            (3, T0 + 10, 30.0, 1, 0, 0, 0), (4, T0 + 35, 40.0, 1, 0, 1, 0)]
    return spark.createDataFrame(rows, SENSOR)
