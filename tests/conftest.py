import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    top = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"file://{top}/warehouse").config("spark.driver.memory", "6g")
        .config("spark.local.dir", f"{top}/local").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
