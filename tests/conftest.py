import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        configure(SparkSession.builder.master("local[8]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
