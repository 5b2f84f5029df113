import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path[:0] = [HERE, ROOT]


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    """Python workers import the package wherever the tests are started."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture
def frame(spark):
    """A DataFrame over several partitions from rows and a schema."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
