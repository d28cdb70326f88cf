import os

import pytest
from pyspark.sql import SparkSession

from erario.session import ship_package

DATA = os.environ.get("ERARIO_TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(f"{DATA}/sf0.001"):
        pytest.skip("no test tables")
    return f"{DATA}/sf0.001"
