import os

import pytest


@pytest.fixture(scope="session")
def tables(spark):
    """Read one of the given tables, or skip where they are not."""

    def read(name, sf="0.001"):
        path = f"/root/testdata/sf{sf}/{name}.parquet"
        if not os.path.exists(path):
            pytest.skip("test tables are not here")
        return spark.read.parquet(path)

    return read
