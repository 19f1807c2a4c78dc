import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def make_session(cores: str = "8"):
    from pyspark.sql import SparkSession

    from starmart.session import DEFAULTS

    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()
