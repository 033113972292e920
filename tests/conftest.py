import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .config("spark.checkpoint.dir", str(shared / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """A DataFrame of lines from texts or dicts."""
    import json

    def make(*items):
        texts = [i if isinstance(i, str) else json.dumps(i) for i in items]
        return spark.createDataFrame(
            [(n, t) for n, t in enumerate(texts)], "_seq bigint, value string"
        ).coalesce(1)

    return make


@pytest.fixture(params=["ansi", "lenient"])
def each_mode(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(request.param == "ansi").lower())
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def record(**fields):
    """A complete record; None leaves a field out."""
    base = {
        "timestamp": "2024-03-10T02:30:00+03:00",
        "request_id": "r1",
        "host": "example.com",
        "status": 200,
        "request": "GET /a/b HTTP/1.1",
    }
    return {k: v for k, v in {**base, **fields}.items() if v is not None}
