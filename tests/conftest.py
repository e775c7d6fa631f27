import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brightweir.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column_values(spark):
    """Apply a column function to plain values: ``column_values(fn, values, type)``."""
    from pyspark.sql import functions as F

    def run(function, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
        return [row.r for row in rows]

    return run
