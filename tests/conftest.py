import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("laserfold-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


POINT_DDL = (
    "x double, y double, z double, intensity int, classification int, return_number int, "
    "number_of_returns int, gps_time double, siteId string, ingestRunId string, ingestTime timestamp"
)


@pytest.fixture(scope="session")
def make_points(spark):
    """Points from (x, y, z, class) tuples, with site and run as options."""

    def build(rows, site="s", run="r"):
        full = [
            (float(x), float(y), float(z) if z is not None else None, 10, c, 1, 1, 0.0, site, run, None)
            for x, y, z, c in rows
        ]
        return spark.createDataFrame(full, POINT_DDL)

    return build
