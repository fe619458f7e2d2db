import os
from datetime import datetime, timedelta

os.environ.setdefault("OMP_NUM_THREADS", "1")

import pytest
from pyspark.sql import SparkSession

SIGHTING_SCHEMA = (
    "placa string, timestamp timestamp_ntz, latitude double, longitude double, regiao_adm string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("fixtrail-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def sample_rows():
    """Ten vehicles with ten fixes each on a straight line, every ten minutes."""
    regions = ["Lago Norte", "Paranoa", "Varjao"]
    start = datetime(2025, 12, 2, 18, 30)
    return [
        (
            f"ABC100{v}",
            start + timedelta(seconds=600 * i),
            round(-15.8 - 0.001 * v - 0.0001 * i, 6),
            round(-47.98 - 0.001 * v - 0.0001 * i, 6),
            regions[(10 * v + i) % 3],
        )
        for v in range(10)
        for i in range(10)
    ]


@pytest.fixture(scope="session")
def sample(spark):
    return spark.createDataFrame(sample_rows(), SIGHTING_SCHEMA)
