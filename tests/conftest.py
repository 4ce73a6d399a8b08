import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rankloom.runtime import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a Column function on a list of strings."""

    def evaluate(function, texts):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        return [r.out for r in rows.select("i", function(F.col("text")).alias("out")).orderBy("i").collect()]

    return evaluate


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
