import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lettora-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a Column function to a list of values, in order."""

    def run(function, inputs, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, v {kind}")
        return [row.out for row in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run


@pytest.fixture
def plan_text():
    """The physical plan before and, once run, after adaptive changes."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
