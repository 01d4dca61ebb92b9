import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.runtime import prepare  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def candles(spark):
    """Makes candles from (symbol, minute, close) or (symbol, minute, close, high, low, volume)."""
    from datetime import datetime, timedelta

    schema = (
        "event_id long, symbol string, endtime timestamp, open double, highest double,"
        " lowest double, close double, volume double"
    )

    def make(rows):
        out = []
        for i, (symbol, minute, close, *rest) in enumerate(rows):
            high, low, volume = rest or (close + 1.0, close - 1.0, 10.0)
            at = datetime(2024, 1, 1) + timedelta(minutes=minute)
            out.append((i, symbol, at, float(close), float(high), float(low), float(close), float(volume)))
        return spark.createDataFrame(out, schema)

    return make
