import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from turnpress.session import local_session

    session = local_session(8, 4)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def apply(spark):
    """Values of one column expression over a list of texts."""

    def run(values, expression, type_="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
        from pyspark.sql import functions as F

        rows = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
        return [r["out"].asDict(True) if hasattr(r["out"], "asDict") else r["out"] for r in rows]

    return run
