import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture(params=["one block", "many blocks"])
def blocking(request, monkeypatch):
    """Run a test with whole episodes and again with blocks of twelve steps and runs of three blocks."""
    from gripline.operators import blocks

    if request.param == "many blocks":
        monkeypatch.setattr(blocks, "BLOCK", 12)
        monkeypatch.setattr(blocks, "FAN", 3)
        monkeypatch.setattr(blocks, "PLAIN_ROWS", 0)
    return request.param
