from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """A session in a zone with daylight saving, so that zone-dependent code shows."""
    base = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny() -> str:
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def small() -> str:
    return f"{TESTDATA}/sf0.01"
