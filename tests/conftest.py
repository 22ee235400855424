import pytest
from pyspark.sql import SparkSession

from riskflow.session import tuned


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
    )
    session = tuned(builder).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A function giving a fresh path below the test's own folder."""
    return lambda name: str(tmp_path / name)


@pytest.fixture
def shuffled_plans(spark):
    """Plans as declared: no small-table broadcasts and no run-time coalescing."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)
