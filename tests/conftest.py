import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from rows import ACTION_SCHEMA  # noqa: E402
from shoplens.session import build_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_spark(master="local[*]", shuffle_partitions=8, app_name="shoplens-tests")
    yield s
    s.stop()


@pytest.fixture
def actions_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, ACTION_SCHEMA)
    return make
