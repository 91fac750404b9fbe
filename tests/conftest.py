from datetime import datetime

import pytest
from pyspark.sql import SparkSession

from kerbline.session import SETTINGS

BIG_PLANS = {
    "spark.kerbline.keyRows": "1",
    "spark.kerbline.distinctValues": "1",
    "spark.kerbline.broadcastBytes": "0",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(home / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def big_plans(spark):
    """Force the plans for large data: sliced windows, ranked quantiles, shuffle joins."""
    before = {k: spark.conf.get(k, None) for k in BIG_PLANS}
    for key, value in BIG_PLANS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(params=["small", "big"])
def both_plans(request):
    """Run a test once with the plans for small data and once with those for large data."""
    if request.param == "big":
        request.getfixturevalue("big_plans")
    return request.param


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Collected rows of a small fixture as plain tuples."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
