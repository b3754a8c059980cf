import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("tradescope-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from tradescope.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf001(spark):
    from tradescope.sources.trades import fixture_trades

    return fixture_trades(spark, "/root/testdata/sf0.001").cache()
