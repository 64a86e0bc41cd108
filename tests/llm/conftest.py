import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_tables import CLASHES, SCHEMA, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns of clashing names, in several partitions."""
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5, F.xxhash64("text", "source"))
    return df.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
