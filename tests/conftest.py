import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from bulletin.session import local_session

    session = local_session("4", shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column builder over a list of strings."""
    from pyspark.sql import functions as F

    def run(build, texts):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, t string")
        return [r[1] for r in df.select("i", build(F.col("t"))).orderBy("i").collect()]

    return run
